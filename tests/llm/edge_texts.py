#: Texts at the edges: missing, empty, white space only, one word, repeated, long, other scripts.
EDGES = [
    None, "", " \n\t ", "one", "two words", "same text here", "same text here", "x" * 70_000, "a " * 5_000,
    "é🙂 ﬁ Ａ \x00 end", "line\nline\nline", "▁ marker  twice ", " lead and trail ", "Of " * 400,
]
