"""Texts that the operators' tests share."""

PROSE = ("the quick brown fox jumps over the lazy dog while seven wizards boil green tea near an old stone bridge and "
         "nobody in the village remembers who had built it or why the river below never freezes in winter").split()


def prose(begin: int, n: int) -> str:
    return " ".join(f"{PROSE[(begin * 7 + i * i) % len(PROSE)]}{(begin + i) % 5 or ''}" for i in range(n))


#: doc_id, text: nulls, empty, blank, one word, ties, repeated rows, shared passages, other scripts, a very long text
ODD = [
    (1, prose(1, 60)), (2, prose(1, 60)), (2, prose(1, 60)), (3, prose(2, 40) + " " + prose(1, 60)), (3, "another text of the same id"),
    (4, None), (5, ""), (6, "  \n\t "), (7, "word"), (8, "word"), (9, "zwei Wörter"), (10, "Привет мир и всё остальное"), (11, "日本語のテキスト 日本語"),
    (12, "12 34 --- ### $$$"), (13, prose(3, 13)), (14, prose(3, 13) + " x"), (15, "a " * 400), (16, "b a " * 300), (17, prose(4, 6000)),
    (18, "y" * 5000), (19, prose(4, 6000) + " end"), (20, "<|endoftext|> don't stop <|endoftext|>"), (21, "nul\x00byte \x85 and   space"),
    (None, prose(1, 60)), (None, None), (-5, prose(5, 30)), (30, prose(5, 30)),
]
