"""Each operator against a plain version, on texts with nulls, blanks, long texts, ties, repeated rows and clashing columns."""

import hashlib
import math
import os
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash

from chatloom.llm import licenses, mixing, packing, quality, rules, simhash, suffix, toxicity, urls
from chatloom.llm.common import components, fold
from chatloom.llm.exact import exact_groups
from tests.llm.conftest import sentence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# ---- 1 suffix dedup


def removed_plainly(rows, window):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    least = {}
    for i, b in texts:
        for p in range(len(b) - window + 1):
            w, k = b[p:p + window], math.inf if i is None else i
            least[w] = min(k, least.get(w, math.inf))
    out = []
    for i, b in texts:
        gone = [False] * len(b)
        for p in range(len(b) - window + 1):
            if least[b[p:p + window]] < (math.inf if i is None else i):
                gone[p:p + window] = [True] * window
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = sum(g and not h for g, h in zip(gone, [False, *gone]))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("few", [32, 1])
def test_suffix_matches_plain(make_docs, corpus, few):
    rows = corpus + [(7, "other text with the id of a row", "s0"), (8, corpus[9][1], "s0")]
    got = suffix.remove_repeats(make_docs(rows), buckets=7, few=few).collect()
    assert Counter(map(tuple, got)) == removed_plainly(rows, 50)


def test_suffix_short_windows_and_text(make_docs):
    rows = [(1, "abcabcabcabcabcabc", "s"), (2, "xxabcabcabcyy", "s"), (3, "zabcabca", "s"), (4, None, "s")]
    got = suffix.remove_repeats(make_docs(rows), window=6, anchor=3, keep_text=True).collect()
    assert Counter(tuple(r)[:5] for r in got) == removed_plainly(rows, 6)
    assert {r["doc_id"]: bytes(r["kept"]) for r in got}[2] == b"xxyy"


def test_suffix_takes_many_texts_without_id(spark):
    docs = spark.range(70_000).selectExpr("cast(null as bigint) as doc_id", "concat('text ', id) as text")
    assert suffix.remove_repeats(docs).filter("doc_id IS NULL AND n_removed = 0").count() == 70_000


def test_merge_never_compares_known_prefixes(monkeypatch):
    rng = random.Random(1)
    keys = sorted("".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(300))
    runs = [sorted(rng.sample(keys, 60)) for _ in range(5)] + [[]]
    packed = []
    for run in runs:
        rows = np.zeros((len(run), 12), np.uint8)
        for i, k in enumerate(run):
            rows[i, : len(k)] = list(k)
        coded = suffix.front_code(rows, np.array([len(k) for k in run], np.int64))
        assert suffix.open_run(list(coded))[0] == run
        packed.append(suffix.open_run(list(coded)))
    looks = []
    shared = suffix._shared
    monkeypatch.setattr(suffix, "_shared", lambda a, b, at: looks.append((a[:at], b[:at])) or shared(a, b, at))
    out = [(packed[r][0][p], s) for r, p, s in suffix.merge_runs(packed)]
    assert [k for k, _ in out] == sorted(k for run in runs for k in run)
    assert all(s == len(os.path.commonprefix([a, b])) for (a, _), (b, s) in zip(out, out[1:]))
    assert all(a == b for a, b in looks)


def test_merge_looks_once_and_in_bulk(monkeypatch):
    rng = random.Random(2)
    runs = []
    for _ in range(5):
        run = sorted({bytes(rng.choice(b"ab\0") for _ in range(rng.randint(1, 40))) for _ in range(2_000)} | {b"a" * 30, b"a" * 30 + b"\0"})
        rows = np.array([list(k.ljust(40, b"\0")) for k in run], np.uint8)
        runs.append((run, suffix.open_run(list(suffix.front_code(rows, np.array([len(k) for k in run]))))))
    looks, calls, look = Counter(), [], suffix._look
    monkeypatch.setattr(suffix, "_look", lambda rows, which, step: looks.update((i, step) for i in which.tolist()) or look(rows, which, step))
    suffix.merge_runs([r for _, r in runs])
    prefixes = [p for _, (_, run) in runs for p in run.tolist()]
    assert looks and max(looks.values()) == 1 and all(prefixes[i] < 8 * step + 8 for i, step in looks)
    monkeypatch.setattr(suffix, "_look", look)
    # no step of Python per key
    sys.setprofile(lambda *call: calls.append(call[1]))
    try:
        merged = suffix.merge_runs([r for _, r in runs])
    finally:
        sys.setprofile(None)
    assert 3 * len(calls) < len(merged)
    plain = sorted((k, r, i) for r, (run, _) in enumerate(runs) for i, k in enumerate(run))
    assert [tuple(x) for x in merged[:, :2].tolist()] == [(r, i) for _, r, i in plain]
    assert merged[1:, 2].tolist() == [len(os.path.commonprefix([a, b])) for (a, _, _), (b, _, _) in zip(plain, plain[1:])]


def test_long_runs_are_opened_in_parts():
    run = [b"%06d" % (7 * i) for i in range(25_000)]
    coded = suffix.front_code(np.array([list(k) for k in run], np.uint8), np.full(len(run), 6))
    assert suffix.open_run(list(coded))[0] == run


def test_anchors_do_not_depend_on_stretches(monkeypatch):
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"abc ") for _ in range(rng.choice([0, 1, 49, 50, 51, 300]))) for _ in range(40)]
    data, ends = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([len(t) for t in texts])

    def windows():
        return [(f, int(a), int(k)) for first, last, a, k in zip(*suffix.anchored_ranges(data, ends, 50, 24)) for f in range(first, last + 1)]

    whole = windows()
    monkeypatch.setattr(suffix, "_STRETCH", 70)
    assert windows() == whole
    assert [f for f, _, _ in whole] == [e - len(t) + i for e, t in zip(ends.tolist(), texts) for i in range(len(t) - 49)]


# ---- 2 SimHash


def plain_fingerprint(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(items, linked):
    group = list(range(len(items)))
    for x in range(len(items)):
        for y in range(x):
            if linked(items[x], items[y]) and group[x] != group[y]:
                old, new = group[x], group[y]
                group = [new if g == old else g for g in group]
    return group


def test_simhash_matches_plain(make_docs, corpus):
    rows = [r for r in corpus if r[0] is not None]
    fps = [plain_fingerprint(t) for _, t, _ in rows]
    group = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    least = defaultdict(lambda: math.inf)
    for (i, _, _), g in zip(rows, group):
        least[g] = min(least[g], i)
    want = Counter((i, f"{f:016x}", least[g]) for (i, _, _), f, g in zip(rows, fps, group))
    got = simhash.near_duplicates(make_docs(rows)).collect()
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got) == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


@pytest.mark.parametrize("n", [200, 10**6, 10**9])
def test_simhash_parts_cover_every_pair(n):
    both = np.full((64, 64), n / 4.0)
    np.fill_diagonal(both, n / 2.0)
    parts = simhash.plan_parts(n, both, 4)
    assert sum(p.threshold + 1 for p in parts) == 5
    assert sorted(b for p in parts for b in p.bits) == list(range(64))


def test_simhash_finds_all_links_of_a_dense_group(spark):
    rng = random.Random(5)
    centre = rng.getrandbits(64)
    fps = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 7))) for _ in range(400)} | {rng.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    distinct = spark.createDataFrame([(f,) for f in signed], "fp bigint").repartition(4)
    links = simhash.near_links(distinct)
    assert links.count() <= 5 * len(fps)
    got = {r["node"]: r["component"] for r in components(distinct.selectExpr("fp as node"), links).collect()}
    group = plain_components(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    assert len({(group[i], got[signed[i]]) for i in range(len(fps))}) == len(set(group)) == len(set(got.values()))


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(5, 5)]
    nodes = spark.createDataFrame([(i,) for i in [*range(41), *range(100, 130), 500]], "node bigint")
    got = {r["node"]: r["component"] for r in components(nodes, spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {500: 500}


# ---- 3 exact dedup


def test_exact_matches_plain(make_docs, corpus):
    rows = [r for r in corpus if r[0] is not None] + [(200, corpus[3][1].replace(" ", "  "), "s0"), (201, "\x0b" + corpus[3][1] + " \r", "s0")]
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups["".join(WORD.findall(t or ""))].append((-len(t or ""), i))
    got = exact_groups(make_docs(rows), slices=4).collect()
    want = Counter((i, min(g)[1], len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for _, i in g)
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == want
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(groups)
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_null_ids_come_last(make_docs):
    got = exact_groups(make_docs([(None, "a b", "s"), (4, "ab ", "s"), (None, None, "s")])).collect()
    assert {(r["doc_id"], r["keep_id"], r["kept"]) for r in got} == {(4, 4, True), (None, 4, False), (None, None, True)}


# ---- 4 licenses


def plain_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def test_licenses_match_windows(make_docs, corpus):
    long = licenses.TEMPLATES[2][1]
    rows = [r for r in corpus if r[0] is not None]
    filler = rows[0][1]
    rows += [(300, filler + " Released under the MIT License. " + filler, "s"), (301, "LICENSED under\nCC BY-NC 4.0", "s"), (302, filler + " " + long, "s"),
             (303, " ".join(long.split()[:-2]), "s"), (304, " ".join(long.split()[:12]), "s"), (305, "This work is licensed under the GNU General Public License version 2", "s"),
             (306, "Released under the MIT", "s")]
    got = {(r["doc_id"], r["template"]): r for r in licenses.license_scan(make_docs(rows)).collect()}
    want = {}
    for i, t, _ in rows:
        words = plain_words(t)
        runs = [tuple(words[j:j + 5]) for j in range(len(words) - 4)]
        for n, (_, statement) in enumerate(licenses.TEMPLATES):
            w = plain_words(statement)
            wanted = {tuple(w[j:j + 5]) for j in range(len(w) - 4)}
            stride = 1 << math.ceil(math.log2(len(wanted)))
            for s in range(0, len(runs), stride):
                share = len(wanted & set(runs[s:s + 2 * stride])) / len(wanted)
                if share >= 0.8:
                    want[i, n] = max(share, want.get((i, n), 0))
    assert {k: r["containment"] for k, r in got.items()} == want
    assert {k[0] for k in want} == {300, 301, 302, 303, 305}
    assert got[301, 11]["first_word"] == 0 and got[301, 11]["last_word"] == 6


# ---- 5 quality


def noisy(rng, i):
    text = sentence(rng, 60).replace(" ", ". ", 3)
    kind = i % 3
    return ["\n".join([text[:150], text[150:]]), " ".join(w + "***" for w in text.split()), (text.upper() + "!! ") * 2][kind], int(kind == 0)


@pytest.fixture(scope="module")
def labelled(spark, make_docs):
    rng = random.Random(8)
    rows = [(i, *noisy(rng, i)) for i in range(240)]
    docs = make_docs([(i, t, "s") for i, t, _ in rows] + [(900, None, "s"), (901, "", "s"), (None, "x y", "s"), (5, rows[5][1], "s")])
    return docs, spark.createDataFrame([(i, q, 0) for i, _, q in rows] + [(None, 1, 1), (0, None, None)], "doc_id bigint, quality int, toxic int"), rows


def test_quality_on_held_out_rows(labelled):
    docs, labels, rows = labelled
    got = quality.quality(docs, labels).collect()
    assert len(got) == 244 and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    assert held and all(by[i]["held_out"] for i, _, _ in held)
    assert sum(by[i]["predicted"] == q for i, _, q in held) >= 0.97 * len(held)
    assert by[900]["n_lines"] == 1 and by[900]["score"] == by[901]["score"]


def test_quality_learns_from_documents_of_many_lines(spark, make_docs):
    rng = random.Random(4)
    rows = [(i, "\n".join((sentence(rng, 8) + "." if i % 2 else "### $$$ *** " * 4) for _ in range(90)), "s") for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id bigint, quality int")
    got = quality.quality(make_docs(rows), labels).collect()
    assert all(r["predicted"] == r["doc_id"] % 2 for r in got)


def test_quality_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(2)
    n = quality.N_FEATURES
    field = quality.LineField(rng.normal(size=3 * n + 1), rng.normal(size=(2, 2)), (np.zeros(n), np.ones(n)))
    rows = rng.normal(size=(5, n))
    good = field.inputs(rows) @ field.weights
    weights = {}
    for z in range(32):
        s = [z >> t & 1 for t in range(5)]
        weights[tuple(s)] = math.exp(sum(good[t] for t in range(5) if s[t]) + sum(field.moves[a, b] for a, b in zip(s, s[1:])))
    total = sum(weights.values())
    want = [sum(w for s, w in weights.items() if s[t]) / total for t in range(5)]
    assert np.allclose(field.marginals(rows), want)
    node, _ = quality._expected(np.stack([np.zeros(5), good], 1)[None], field.moves, np.ones((1, 5)))
    assert np.allclose(node[0], want)


# ---- 6 packing


def test_packing_round_trip(make_docs, corpus):
    from tokenizers import Tokenizer

    rows = [r for r in corpus if r[0] is not None and r[0] != 166] + [(400, "a  b \n c<|endoftext|> d\u00a0 e  ", "s"), (401, corpus[0][1] * 12, "s"), (402, "a <|endoftext|> b", "s"), (403, "<|endoftext|>", "s")]
    got = packing.pack_documents(make_docs(rows), TOKENIZER, capacity=256, keep_ids=True).collect()
    coder = Tokenizer.from_file(TOKENIZER)
    by, seqs = defaultdict(list), defaultdict(list)
    for r in got:
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] and zlib.crc32(r["ids"]) == r["ids_crc32"]
        by[r["doc_id"]].append((r["piece"], r["start"], ids))
        seqs[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, t, _ in rows:
        pieces = sorted(by[i], key=lambda x: x[0])
        want = [*coder.encode(t or "", add_special_tokens=False).ids, 0]
        assert np.concatenate([p[2] for p in pieces]).tolist() == want
        assert all(len(p[2]) == 256 for p in pieces[1:]) and [p[1] for p in pieces] == np.cumsum([0] + [len(p[2]) for p in pieces[:-1]]).tolist()
    total = 0
    for spans in seqs.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 256
        total += end
    assert len(seqs) <= 1.05 * math.ceil(total / 256)


@pytest.mark.parametrize("limits", [{}, {"max_pieces": 3}, {"max_cost": 100 * 100 // 2 + 100 * 50}])
def test_best_fit_keeps_every_capacity(limits):
    rng = random.Random(4)
    counts = {n: rng.randint(0, 20) for n in range(1, 101)}
    slots = packing.best_fit(counts, 100, **limits)
    bins, placed = defaultdict(list), Counter()
    for s in slots:
        placed[s.length] += s.copies * s.bins
        for b in range(s.bins):
            bins[s.sequence + b] += [(s.offset + k * s.length, s.length) for k in range(s.copies)]
    assert placed == Counter({n: c for n, c in counts.items() if c})
    for content in bins.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= 100 and len(content) <= limits.get("max_pieces", 100)
        assert sum(n * n for _, n in content) <= limits.get("max_cost", 10_000)
    if not limits:
        rooms = []
        for n in sorted((n for n, c in counts.items() for _ in range(c)), reverse=True):
            fit = min((r for r in rooms if r >= n), default=None)
            if fit is not None:
                rooms.remove(fit)
            rooms.append((100 if fit is None else fit) - n)
        assert len(bins) <= len(rooms) * 1.01


def test_packing_repeated_and_empty(make_docs):
    got = packing.pack_documents(make_docs([(1, "a b", "s"), (1, "a b", "s"), (None, None, "s")]), TOKENIZER).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == 3


# ---- 7 urls

RULES = [urls.parse_rule("net/", "block"), urls.parse_rule("example.net/en/", "allow"), urls.parse_rule("example.com/de/", "block"), urls.parse_rule("org/fr/", "allow")]


def plain_rule(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best


def test_urls_match_plain(spark):
    given = ["http://a.EXAMPLE.net/en/1?x=/de/", "http://example.net", "https://example.net/de/2#a/b", "ftp://xexample.net/q", "http://fooexample.com/de/x", "http://example.com/de/x",
             "http://w.example.com?/de/", "https://É.Org/fr/", "no scheme", "", None, "http://a.org/fr/x://y", "://net/", "http://net/", "http://x.example.com/en/" + "z" * 5000]
    given += [f"http://{'spam-9%d' % i if i % 2 else 'site'}.example.{'com' if i % 2 else 'org'}/{'de' if i % 2 else 'fr'}/{i}" for i in range(60)]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(given)] + [(None, given[0], "x", "y"), (0, given[0], "x", "y")], "page_id bigint, url string, score string, suffix string")
    got = urls.url_filter(pages, RULES, trees=3).collect()
    assert len(got) == len(given) + 2
    for r in got:
        host, path, rule = plain_rule(given[r["page_id"] or 0])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.text)
        assert r["verdict"] == rule.verdict if rule else r["verdict"] in ("allow", "block")


def test_urls_learn_labels(spark):
    rng = random.Random(6)
    rows = [(f"http://{sentence(rng, 1)}.example.org/{'9' * (i % 2 * 12)}{sentence(rng, 1)}", i % 2) for i in range(200)]
    pages = spark.createDataFrame([(i, u) for i, (u, _) in enumerate(rows)], "page_id bigint, url string")
    labels = spark.createDataFrame(rows[:100] + [(None, None)], "url string, label int")
    got = {r["page_id"]: r["verdict"] for r in urls.url_filter(pages, [], labels, trees=3).collect()}
    assert sum(got[i] == ("block" if y else "allow") for i, (_, y) in enumerate(rows) if i >= 100) >= 95
    none = urls.url_filter(pages, []).select("verdict", "score").distinct().collect()
    assert [tuple(r) for r in none] == [("allow", None)]


# ---- 8 rules


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] >= 2 for k in range(3)}
    lines, seen, dup = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_rules_base_matches_plain(spark, make_docs, corpus):
    rows = corpus + [(500, "a b c\na b c\nx\n\n \nx", "s"), (501, "a a a a", "s"), (502, "☃ é\u00a0x #*$%&|<>", "s"), (503, "one two", "s")]
    got = rules.quality_rules(make_docs(rows), spark.createDataFrame([], "doc_id bigint, quality int")).collect()
    want = Counter()
    for i, t, _ in rows:
        n, chars, symbols, dup, repeat = plain_statistics(t)
        bad = n < 50 or 100 * repeat > 50 * n
        want[i, n, chars, symbols, dup, repeat, bad, not bad] += 1
    keys = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert Counter(tuple(r[k] for k in keys) for r in got) == want


@pytest.mark.parametrize("k,n,p", [(0, 10, 0.1), (3, 40, 0.05), (25, 400, 0.05), (7, 7, 0.3), (900, 20_000, 0.05)])
def test_binomial_tail_is_exact(k, n, p):
    plain = sum(math.exp(math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p)) for i in range(k + 1))
    assert rules.binomial_tail(k, n, p) == pytest.approx(plain, rel=1e-7)


def test_rules_cutoffs_respect_the_bound(spark):
    rng = random.Random(9)
    stats = [(i, "en", 100, 500, 40 if i % 200 == 0 else rng.randint(0, 4), 0, 0, 5, 0) for i in range(4000)] + [(i, "xx", 100, 500, 0, 0, 0, 5, 0) for i in range(5000, 5020)]
    frame = spark.createDataFrame(stats, rules.STATISTICS)
    good = spark.createDataFrame([(s[0],) for s in stats], "doc_id bigint")
    got = {(r["stratum"], r["rule"]): r for r in rules.controlled_cutoffs(frame, good, alpha=0.08).collect()}
    assert all(k[0] == "en" for k in got)  # twenty documents prove nothing
    cut = got["en", "symbols"]
    assert cut["rejected"] == 20 and 0.04 <= cut["cutoff"] < 0.1
    assert cut["bound_p"] <= 0.05 / 8 and rules.binomial_tail(cut["rejected"], cut["n"], 0.02) == pytest.approx(cut["bound_p"])


def test_rules_judge_strata_with_few_labels(spark):
    texts = {True: "quiet words that differ " + " ".join(f"w{i}" for i in range(60)), False: "## ** $$ " * 10 + " ".join(f"v{i}" for i in range(60))}
    sizes = {"aa": 300, "bb": 300, "cc": 300, "dd": 30}
    rows = [(1000 * k + i, texts[i < n], lang) for k, (lang, n) in enumerate(sizes.items()) for i in range(n + 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    labels = spark.createDataFrame([(i, int(t == texts[True])) for i, t, _ in rows], "doc_id bigint, quality int")
    got = rules.quality_rules(docs, labels).collect()
    assert {r["stratum"] for r in got if r["failed_rules"]} == set(sizes)
    assert all(r["kept"] == (r["n_symbols"] == 0) for r in got)
    assert rules.labels_needed(4, 0.02, 0.025) == 252 and rules.labels_needed(1, 0.02, 0.025) == 183


def test_rules_are_proven_together(spark):
    # each rule alone may lose 2 percent of the good documents, both together may not
    stats = [(i, "en", 100, 500, 60 * (i % 60 == 0), 0, 0, 5, 60 * (i % 60 == 30)) for i in range(1200)]
    frame, good = spark.createDataFrame(stats, rules.STATISTICS), spark.createDataFrame([(s[0],) for s in stats], "doc_id bigint")
    got = rules.controlled_cutoffs(frame, good).collect()
    assert {r["rule"] for r in got} == {r.name for r in rules.RULES} and len({(r["rejected"], r["n"]) for r in got}) == 1
    assert got[0]["rejected"] <= 24 and rules.binomial_tail(got[0]["rejected"], got[0]["n"], 0.02) <= 0.05


# ---- 9 toxicity


def test_block_max_search_is_exact():
    rng = random.Random(11)
    vectors = []
    for _ in range(500):
        raw = {t: rng.random() for t in rng.sample(range(30), rng.randint(1, 6))}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        vectors.append({t: w / norm for t, w in raw.items()})
    vectors[77] = dict(vectors[3])
    index = toxicity.BlockMaxIndex(vectors, 30, block=16)
    for query in vectors[:60]:
        plain = sorted(((-round(sum(w * v.get(t, 0) for t, w in query.items()), 12), i) for i, v in enumerate(vectors)))
        want = [i for s, i in plain if s < 0][:7]
        assert [i for _, i in index.search(query, 7)] == want
    assert index.search({}, 3) == []


def test_toxicity_learns_and_explains(spark, make_docs):
    rng = random.Random(12)
    rows = []
    for i in range(400):
        words = sentence(rng, 50).split()
        if i % 5 == 0:
            words[rng.randrange(50)] = "vile"
            words[rng.randrange(50)] = "Nasty,"
        rows.append((i, " ".join(words), "s"))
    docs = make_docs(rows + [(900, None, "s"), (901, "", "s"), (None, "vile nasty", "s"), (3, rows[3][1], "s"), (902, "clean " * 3000 + "vile nasty", "s")])
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(None, 1), (1, None)], "doc_id bigint, toxic int")
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == 405
    by = {r["doc_id"]: r for r in got}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(by[i]["held_out"] and by[i]["predicted"] == (i % 5 == 0) for i in held)
    assert by[None]["predicted"] == by[902]["predicted"] == 1 and by[900]["predicted"] == by[901]["predicted"] == 0
    assert by[902]["evidence"] and all(e % 5 == 0 for e in by[902]["evidence"])


def test_calibration_is_monotone():
    knots = toxicity._monotone([(0.1, 10, 1), (0.3, 10, 0), (0.5, 4, 3), (0.9, 10, 9)])
    assert all(a[0] < b[0] and a[1] <= b[1] for a, b in zip(knots, knots[1:]))


# ---- 10 mixing


def plain_targets(sizes, weights=(5, 2, 1), cap=3):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free = {}, set(names)
    while True:
        left = sum(sizes.values()) - sum(target.values())
        level = left / max(1, sum(weight[s] for s in free))
        over = {s for s in free if level * weight[s] >= cap * sizes[s]}
        if not over:
            return target | {s: level * weight[s] for s in free}
        target |= {s: cap * sizes[s] for s in over}
        free -= over


def test_mixing_targets_and_rounding(make_docs, corpus):
    rows = [r for r in corpus if r[0] is not None] + [(600 + i, "w " * (5 + i % 7), "tiny") for i in range(9)] + [(700 + i, "w " * 3, f"m{i:02d}") for i in range(30)]
    docs = make_docs(rows)
    got = mixing.mix_sources(docs, fan_in=4, rows_per_slice=10).collect()
    again = mixing.mix_sources(docs.repartition(5), fan_in=4, rows_per_slice=10).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again)) and len(got) == len(rows)
    sizes, largest, taken = Counter(), Counter(), Counter()
    for i, t, s in rows:
        n = len(WORD.findall(t or ""))
        sizes[s] += n
        largest[s] = max(largest[s], 2 * n)  # a repeated id counts as one document
    target = plain_targets(dict(sizes))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= largest[s] for s in sizes)


def test_mixing_keeps_expected_copies(make_docs):
    docs = make_docs([(i, "w " * (1 + i % 9), "ab"[i % 2]) for i in range(40)])
    mean = Counter()
    for seed in range(12):
        for r in mixing.mix_sources(docs, seed=seed, fan_in=8).collect():
            mean[r["doc_id"]] += r["copies"] / 12
    rate = {r["doc_id"]: r["target"] / r["source_size"] for r in mixing.mix_sources(docs, fan_in=8).collect()}
    assert abs(sum(mean[i] - rate[i] for i in rate) / 40) < 0.06 and all(abs(mean[i] - rate[i]) < 0.6 for i in rate)


# ---- all: empty tables


def test_empty_tables(spark, make_docs):
    docs = make_docs([])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    results = [
        suffix.remove_repeats(docs), simhash.near_duplicates(docs), exact_groups(docs), licenses.license_scan(docs), quality.quality(docs, labels),
        packing.pack_documents(docs, TOKENIZER), rules.quality_rules(docs, labels), toxicity.toxicity(docs, labels), mixing.mix_sources(docs),
        urls.url_filter(spark.createDataFrame([], "page_id bigint, url string"), RULES)]
    assert [r.count() for r in results] == [0] * 10
    assert all(len(r.columns) > 3 for r in results)


def test_no_labels(spark, make_docs, corpus):
    docs = make_docs(corpus[:5])
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert {r["score"] for r in quality.quality(docs, labels).collect()} == {0.5}
    assert {round(r["score"], 6) for r in toxicity.toxicity(docs, labels).collect()} == {0.1}


def test_fold_is_crc32_of_the_written_id(spark):
    got = spark.range(50).select("id", fold("id", 5).alias("f")).collect()
    assert all(r["f"] == zlib.crc32(str(r["id"]).encode()) % 5 for r in got)


def test_encoder_encodes_a_word_once_for_all_marks_and_lines():
    coder = packing.Encoder(TOKENIZER)
    plain = coder.tokenizer
    words = ["therthble", "Ñjacoie", "ofansthain", "x1", "don't", "w" * 60]
    rng = random.Random(4)
    gaps = [" ", " ", " ", "\n", "\n", "\n\n", " \n", "\n ", "  ", "\r\n", "\t", "\u3000"]
    texts = ["".join(rng.choice(words) + rng.choice(["", ".", ",", "!!", "$$$", "-", ".)"]) + rng.choice(gaps) for _ in range(rng.randint(0, 30))) for _ in range(400)]
    assert coder.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert not any(len(x) > 48 for x in coder.known)
    seen, ids = [], coder._ids
    coder._ids = lambda x: seen.extend(x) or ids(x)
    coder.known.clear()
    coder.encode(["a " + " ".join(f"therthble{m} Etoueux{m}\nEtoueux{m}" for m in (".", ",", "!", "?", ";", ":", "")) + " b"])
    assert sum(t.count("therthble") + t.count("Etoueux") for t in seen) == 3


def test_encoder_keeps_what_it_still_needs():
    coder = packing.Encoder(TOKENIZER, most=60)
    seen, ids = [], coder._ids
    coder._ids = lambda x: seen.extend(x) or ids(x)
    for i in range(8):
        coder.encode(["a therthble " + " ".join(f"{chr(97 + i)}{chr(97 + j)}q" for j in range(20))])
    assert sum(t.count("therthble") for t in seen) == 1


def test_encoder_cuts_at_marks_and_line_feeds_and_keeps_little():
    coder = packing.Encoder(TOKENIZER)
    plain, seen, ids = coder.tokenizer, [], coder._ids
    coder._ids = lambda x: seen.extend(x) or ids(x)
    coder.encode(["a " + " ".join(f"2024{m} größtebé{m}" for m in (".", ",", "!", "", "$$")) + "\n2024\n2024"])
    assert sum(t.count("2024") for t in seen) == 2 and sum(t.count("größtebé") for t in seen) == 1
    rng = random.Random(5)
    gaps = [" ", "\n", " ", " ", " ", " ", "　", "\x85", "\t", "  "]
    words = ["né", "«ja»", "“quote”", "×", "2024", "語、", "don't", "'s", "᠎", "̀", "<|endoftext|>", "\x00"]
    texts = ["".join(rng.choice(words) + rng.choice(["", ".", "|", "!'"]) + rng.choice(gaps) * rng.randint(0, 3) for _ in range(rng.randint(0, 20))) for _ in range(500)]
    assert coder.encode(texts) == [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    coder.encode([" ".join(f"w{i}x{i * i}" for i in range(20_000))])
    kept = len(list(coder.known))
    assert kept >= 20_000 and coder.known.chunks.nbytes + coder.known.ids.nbytes < 70 * kept


def test_components_of_few_edges_take_no_shuffles(spark, monkeypatch):
    from chatloom.llm import common

    rng = random.Random(12)
    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(300)] + [(rng.randrange(2000, 2600), rng.randrange(2000, 2600)) for _ in range(400)] + [(5, 5), (7, 6), (-9, -3), (-3, 4000)]
    reach = {i: i for i in range(-20, 4010)}
    for _ in range(len(edges)):
        before = dict(reach)
        for a, b in edges:
            reach[a] = reach[b] = min(reach[a], reach[b])
        if reach == before:
            break
    nodes = spark.createDataFrame([(i,) for i in reach], "node bigint")
    frame, cuts, cut = spark.createDataFrame(edges, "a bigint, b bigint").repartition(8), [], common.cut_narrow
    monkeypatch.setattr(common, "cut_narrow", lambda df, n: cuts.append(cut(df, n)) or cuts[-1])
    assert {r["node"]: r["component"] for r in components(nodes, frame).collect()} == reach
    assert len(cuts) == 1 and cuts[0].rdd.getNumPartitions() == 1
    # more edges than one partition may hold: rounds, the same components
    assert {r["node"]: r["component"] for r in components(nodes, frame, few=100).collect()} == reach
    assert len(cuts) > 3
    assert components(nodes.limit(0), frame.filter("a < b AND a > b")).count() == 0
    # any checkpoint of few rows: one partition per so many
    assert [cut(frame, n).rdd.getNumPartitions() for n in (50_000, 400, 1)] == [1, math.ceil(len(edges) / 400), 8]
