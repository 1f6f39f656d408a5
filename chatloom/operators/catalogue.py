"""Default sentences and word lists for synthesis. Callers may pass their own in the same shape."""

from __future__ import annotations

# Voices of small-shop customers; the name carries the polarity (6 positive, 5 negative, 3 neutral).
TEMPLATES: dict[str, list[str]] = {
    "gratitude_positive": [
        "Thank you for the {domain}, my grandmother has not stopped smiling.", "A wonderful {domain}, and a handwritten note on top!",
        "Please tell the workshop that their {domain} made our anniversary.", "We are satisfied twice over: the {domain} fits and the colour is right.",
        "Whoever packed the {domain} deserves a raise!",
    ],
    "returning_positive": [
        "Third {domain} from this shop, third success.", "I came back for another {domain} because the first still looks new.",
        "My neighbour asked where the {domain} is from, so here we are ordering four.", "The best {domain} in the valley, says my whole choir.",
        "Same maker, same care, one more {domain} for the cottage.", "Ten winters on, the {domain} has outlived two roofs.",
    ],
    "surprise_positive": [
        "I expected a toy and unpacked an incredible {domain}.", "The {domain} was meant as a joke present and is now used daily.",
        "Picked at random, and the {domain} turned out to be a small treasure.", "My cat approves of the {domain}, which says everything!",
    ],
    "learner_positive": [
        "As a beginner I understood the {domain} after one cup of tea.", "The booklet taught me more about the {domain} than a whole evening class.",
        "I built the {domain} with my son and nobody shouted.", "Even with my two left hands the {domain} came together.",
        "One phone call cleared up my question about the {domain}.",
    ],
    "market_positive": [
        "Sold out by noon: visitors loved the {domain}!", "Our stall has never had so many questions about one {domain}.",
        "The {domain} drew a crowd and the crowd drew a crowd.", "Half the price of the {domain} next door and twice as sturdy.",
    ],
    "quiet_positive": [
        "The {domain} simply does its work, day after day.", "No fuss, no noise, a {domain} as it should be.", "I forgot I owned a {domain}, that is how smoothly it runs.",
    ],
    "waiting_negative": [
        "Week seven, and the {domain} is still said to be on a ship.", "The {domain} missed the wedding it was ordered for.",
        "Tracking shows my {domain} circling the same depot.", "They moved the date for the {domain} again without a word.",
        "A birthday came and went, the {domain} did neither.",
    ],
    "workshop_negative": [
        "Two legs of the {domain} are shorter than the others.", "With its terrible glue the {domain} smells through a closed door.",
        "The screws of the {domain} belong to some other thing.", "The seams are poor, and the {domain} frays where the hand goes.",
        "I sanded the {domain} for an hour and it still splinters.", "Whoever drilled the {domain} did it in the dark.",
    ],
    "refund_negative": [
        "They want photographs of the broken {domain} in triplicate.", "My money for the {domain} is apparently under review since spring.",
        "I sent the {domain} back and received the same one again.", "The worst part is not the {domain} but the form to return it.",
    ],
    "expectation_negative": [
        "The picture showed a {domain}, the parcel held a splinter of one.", "I am disappointed: this {domain} is a third of the size I measured out.",
        "A bad copy of the {domain} I saw at the fair.", "The green {domain} is brown, and the brown comes off.",
        "For this money I could have carved the {domain} myself.",
    ],
    "family_negative": [
        "The children refuse to go near the {domain}.", "My sister keeps the {domain} in the shed, face to the wall.", "Even the dog walked out when the {domain} was switched on.",
    ],
    "inventory_neutral": [
        "Shelf nine holds one {domain} and a spare lid.", "The {domain} is listed under letter K.", "Two people are needed to lift the {domain}.",
        "The {domain} came with a linen bag.", "Our {domain} stands between the window and the stove.",
    ],
    "question_neutral": [
        "Does the {domain} exist in a left-handed version?", "How deep is the {domain} with its cover on?", "Which oil is meant for the {domain}?", "May the {domain} stay outside in October?",
    ],
    "diary_neutral": [
        "Tuesday: moved the {domain} upstairs.", "Wrote the serial number of the {domain} into the blue folder.", "The {domain} was dusted before the guests came.",
    ],
}

LEXICON: dict[str, list[str]] = {
    "garden": ["wheelbarrow", "trellis", "rain barrel", "birdhouse", "hedge trimmer", "bench"],
    "workroom": ["lathe", "vice", "sewing box", "plane", "drying rack", "stool"],
    "music": ["concertina", "music stand", "zither", "metronome", "drum", "reed case"],
    "hiking": ["tent", "walking stick", "lantern", "flask", "map case", "rucksack"],
    "winter": ["sledge", "quilt", "ember pan", "snow shovel", "muff", "draught stopper"],
}

# They decide what the text mutations do.
ADJECTIVES = ["wonderful", "satisfied", "best", "incredible", "terrible", "disappointed", "worst", "poor", "bad"]
INTENSIFIERS = ["really", "truly", "absolutely", "exceptionally", "incredibly", "decidedly", "somewhat", "quite"]
ENDINGS = [".", "!", "!!", "...", "!?"]

# The envelopes the answer contracts expect. The first one is also the evaluation prompt.
TASK_ENVELOPES = {
    "classify": "Classify the sentiment: '{text}'",
    "triage": "Triage this support ticket: '{text}'",
    "api": "Translate to API payload: '{text}'",
    "redact": "Redact PII from this transcript: '{text}'",
}

INSTRUCTIONS = [
    TASK_ENVELOPES["classify"],
    "A customer wrote: '{text}'. How do they feel about it?",
    "Positive, Negative or Neutral? Answer with one word for: '{text}'",
    "{text}\n\nWhich mood does the message above show?",
    "Sort this message into the tray it belongs to (good, bad, plain): '{text}'",
]
