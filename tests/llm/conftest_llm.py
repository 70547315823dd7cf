"""Rows with every awkward case, shared by the tests of the operators."""

PROSE = "The quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree. "
EDGES = [
    (1, "Plain words, one line that ends well and has enough of them to count."), (2, None), (3, ""), (4, " \t\n "), (5, "one"),
    (6, PROSE * 1500), (7, "same text twice here"), (7, "same text twice here"), (8, "same text twice here"), (None, "no key but a text of its own"),
    (9, "a\nb\na\n\n"), (10, "x" * 3000), (11, "Ünïcödé Σας 日本語 🎉 <|endoftext|> it's 3.14"), (7, "same key, other text"), (None, None),
]
