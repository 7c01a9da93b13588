"""Rows that every operator must stand."""

LONG = " ".join(f"word{i % 977} {i}" for i in range(60_000))
PASSAGE = " ".join(f"Passage{i} of common words." for i in range(15))
#: (doc_id, text, source): nulls, empty and blank texts, a very long one, ties and repeated rows.
EDGES = [
    (1, "One two three four five six seven eight nine ten eleven twelve.", "a"),
    (1, "One two three four five six seven eight nine ten eleven twelve.", "a"),
    (2, "one TWO three four five six seven eight nine ten eleven twelve.", "b"),
    (3, None, "a"), (4, "", None), (5, " \t\n \r", "b"), (6, "short text", None), (7, "short text", "c"),
    (None, "No id here, but a@b.co and some words to go with it all the way.", "c"),
    (None, None, None), (8, LONG, "a"), (8, "the same id with another text", "b"),
    (9, f"Alpha beta. {PASSAGE}", "a"), (10, f"Gamma delta. {PASSAGE}\nLast line", "b"),
    (11, "x" * 300_000, "c"), (12, "naïve Ünïcode — 中文 текст 😀 \x00 \x85 end", "c"),
]
