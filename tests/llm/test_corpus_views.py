"""Page texts, source divergence and the conversation trie against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from chatloom.llm import conversation_trie as trie
from chatloom.llm import divergence
from chatloom.llm.html_text import common_lines, main_text, page_lines
from tests.llm.conftest import sentence

# ---- 11 pages


def lcs_length(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@pytest.mark.parametrize("bits", [1 << 26, 20])
def test_common_lines_are_a_longest_common_subsequence(bits):
    rng = random.Random(1)
    for _ in range(800):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(0, 14))] for _ in "ab")
        at = common_lines(a, b, bits)
        rest = iter(b)
        assert at == sorted(set(at)) and len(at) == lcs_length(a, b)
        assert all(a[i] in rest for i in at)


def test_lines_of_odd_markup():
    html = ('<!DOCTYPE html><head><title>t</title><style>p{}</style><script>"<p>no</p>"</script></head><div class="has-sidebar"><header>top</header><nav><li>menu</nav>'
            '<article><h1>T &am</h1><p><b>A  b.<br><p>C&amp; d <span class="ad">buy</span> e<!-- no --><ul><li>1<li>2</ul><div id="reader-comments"><p>hm</p></div>'
            '<form><p>mail</p></form></article></div><p>tail')
    kept = [t for t, state, article in page_lines(html) if article and not state]
    assert kept == ["T &am", "A b.", "C& d e", "1", "2"]
    assert [t for t, state, article in page_lines(html) if not state and not article] == ["tail"]
    assert page_lines("") == [] and page_lines("plain < text")[0][0] == "plain < text"


def test_main_text(spark):
    frame = "<div>Home of things</div><p>We use cookies here.</p>{}<p>All rights reserved</p>"
    bodies = {i: f"<p>{sentence(random.Random(i), 8)}</p><p>{sentence(random.Random(i + 50), 4)}</p>" for i in range(8)}
    rows = [(i, f"https://Host.example/{'ab'[i % 2]}/{i}?q", frame.format(bodies[i])) for i in range(6)]
    rows += [(20, "https://solo.example/x", frame.format(bodies[6])), (21, None, frame.format(bodies[7])), (22, "no scheme", None), (None, "https://host.example/a/2", ""),
             (23, "https://two.example/1", "<article><p>Same</p></article>"), (24, "https://two.example/2", "<article><p>Same</p></article>"),
             (25, "https://copy.example/1", "<p>One</p><p>Two</p>"), (26, "https://copy.example/2", "<p>One</p><p>Two</p>")]
    rows += [rows[0], rows[0]]
    pages = spark.createDataFrame([(*r, "x", "y", 1) for r in rows], "page_id bigint, url string, html string, text string, host string, row int")
    got = main_text(pages, bucket=2).collect()
    assert len(got) == len(rows)

    def plain(i):
        return "\n".join(re.findall("<p>(.*?)</p>", bodies[i]))

    by = defaultdict(set)
    for r in got:
        by[r.page_id].add((r.text, r.n_chars))
    assert all(len(x) == 1 for x in by.values())
    for i in range(6):
        assert by[i] == {(plain(i), len(plain(i)))}
    assert by[20] == {(t := "\n".join(["Home of things", "We use cookies here.", plain(6), "All rights reserved"]), len(t))} or next(iter(by[20]))[0] == t
    assert by[22] == by[None] == {("", 0)} and by[23] == by[24] == {("Same", 4)} and by[25] == by[26] == {("One\nTwo", 7)}
    assert main_text(pages.limit(0)).collect() == []


# ---- 12 divergence


def plain_divergence(rows, least, top):
    docs, term = [], re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    for text, lang, source in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        docs.append((lang or "", source or "", Counter(term.findall(low))))
    out = set()
    for lang in {d[0] for d in docs}:
        df = Counter(t for g, _, c in docs if g == lang for t in c)
        kept = sorted(t for t, n in df.items() if n >= least)
        counts = {s: Counter() for g, s, _ in docs if g == lang}
        for g, s, c in docs:
            if g == lang:
                counts[s].update({t: n for t, n in c.items() if t in set(kept)})
        whole = sum(counts.values(), Counter())

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 5) // (sum(c.values()) + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode()) for o in counts if o != s))
            out |= {(lang, s, "pair", o.decode(), -v, i + 1) for i, (v, o) in enumerate(pairs)}
            terms = sorted((q[t] - p[s][t], t.encode()) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            out |= {(lang, s, "term", t.decode(), -v, i + 1) for i, (v, t) in enumerate(terms)}
    return out


@pytest.mark.parametrize("block", [256, 2])
def test_divergence_matches_plain(spark, block):
    rng = random.Random(2)
    words = ["Aa", "bb", "ÉÉ", "straße", "dd-ee", "x1y", "ff", "K", "gg"]
    rows = [(" ".join(rng.choice(words[: rng.randint(2, 9)]) for _ in range(rng.randint(0, 12))), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", "é", None])) for _ in range(150)]
    rows += [rows[0]] * 30 + [(None, "en", "empty"), ("", "en", "s1"), ("one", "xx", "s1"), (None, "xx", "s2"), ("aa " * 5000, "de", "s1")]
    docs = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "text string, lang string, source string, n int, term string, p int")
    got = [tuple(r) for r in divergence.source_divergence(docs, 10, 3, block, 3).collect()]
    assert len(got) == len(set(got)) and set(got) == plain_divergence(rows, 10, 3)
    assert divergence.source_divergence(docs.limit(0)).collect() == []


# ---- 13 trie


def test_radix_tree_layouts():
    rng = random.Random(3)
    tree, keys = None, {bytes([i]) + b"xx" for i in range(256)} | {b"ab" + bytes([i, 7]) for i in range(40)} | {b"abc", b"abcd" * 3}
    keys |= {bytes(rng.randint(0, 3) for _ in range(rng.randint(1, 9))) for _ in range(300)}
    for k in rng.sample(sorted(keys), len(keys)):
        tree = trie.insert(tree, k, k)
    tree = trie.insert(tree, b"abc", b"abc")
    found, kinds, work = [], set(), [(tree, b"")]
    while work:
        node, before = work.pop()
        path = before + node.path
        if node.value is not None:
            assert node.value == path
            found.append(path)
        if node.kids is not None:
            kinds.add(getattr(node.kids, "room", type(node.kids)))
            held = list(node.kids.items())
            assert [b for b, _ in held] == sorted(b for b, _ in held) and all(node.kids.get(b) is c for b, c in held)
            work += [(c, path + bytes([b])) for b, c in held]
    assert sorted(found) == sorted(keys) and {4, 16, trie.Direct} <= kinds


def plain_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append((turn is not None, turn or 0, hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest(), role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in convs.items()}
    nodes = defaultdict(list)
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(built[c]) + 1):
            nodes[tuple(built[c][:d])].append(c)
    children = Counter(k[:-1] for k in nodes if k)
    leaves, saved = Counter(), Counter()
    for k, members in nodes.items():
        size = (len(members) - 1) * len(k[-1][1].encode()) if k else 0
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += size
    out = Counter()
    for k, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(k))
        out[min(members), len(k), min(nodes[k[:-1]]) if k else None, len(members), children[k], leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("piece,chunk", [(512, 4 << 20), (2, 200), (3, 1)])
def test_trie_matches_plain(spark, piece, chunk):
    rng = random.Random(4)
    rows = []
    for c in range(60):
        same = rng.random() < 0.7
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, "user" if t % 2 else "model", f"hot {t % 3}" if same else f"text {rng.randint(0, 3)}"))
    long = [f"turn {i // 3}" for i in range(40)]
    rows += [(100 + j, i, "user", x + ("!" if i > 30 + j else "")) for j in range(0, 20, 5) for i, x in enumerate(long)]
    rows += [(200, None, None, None), (200, 1, "", ""), (200, 1, "a", "é"), (200, 1, "a", "é"), (None, 1, "a", "b"), (201, 5, "a:b", "c"), (205, 5, "a", ":bc"), (206, 1, "user", None)]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, key string, place int")
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    got = Counter(map(tuple, trie.conversation_trie(turns, piece, chunk).select(cols).collect()))
    assert got == plain_trie(rows)
    if piece == 3:
        assert trie.conversation_trie(turns.limit(0)).collect() == []
