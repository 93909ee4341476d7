"""Rows with the cases every document operator has to stand."""

import random


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice(["an", "be", "co", "du", "él", "fi", "go", "ß"]) for _ in range(r.randint(1, 4))) for _ in range(n))


def corpus() -> list[tuple]:
    """(doc_id, text): nulls, empty and white texts, one very long text, copies, near copies, a passage in many texts, repeated rows."""
    passage = words(7, 60)
    base = words(1, 300).split()
    rows = [(0, words(2, 80)), (1, None), (2, ""), (3, " \t\n"), (4, " ".join(base)), (5, " ".join(base)), (6, words(3, 6000)),
            (7, " ".join([*base[:150], "changed", *base[151:]])), (8, passage), (9, f"{words(4, 40)} {passage} {words(5, 30)}"),
            (10, f"{passage}\n{passage}"), (11, "a"), (12, "a b c"), (13, "x" * 500), (14, "x" * 500), (15, "y" * 450), (None, words(6, 70)), (None, None),
            (16, "it's we'll DON'T  　 12½ <|endoftext|> 漢字 😀!!  "), (17, words(8, 90)), (17, words(8, 90)), (-3, words(9, 55))]
    rows += [(100 + i, f"{words(200 + i, 20 + i)} {passage} {words(300 + i, 25)}") for i in range(12)]
    rows += [(200 + i, " ".join([*base[:10 * i], f"edit{i}", *base[10 * i + 1:]])) for i in range(12)]
    return rows
