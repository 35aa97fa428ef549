"""Small inputs and plain reference computations for the training-data operators."""

from __future__ import annotations

import random
import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, source string, score double, kept string"


def prose(n: int, seed: int) -> str:
    """n words of an invented language, some of them frequent."""
    draw = random.Random(seed)
    known = ["the", "of", "and"] + ["".join(draw.choice("abdeinorst") for _ in range(draw.randint(2, 7))) for _ in range(60)]
    out = [draw.choice(known) + draw.choice(["", "", "", ".", ".\n"]) for _ in range(n)]
    return " ".join(out)


def documents() -> list[tuple]:
    """Copies, near copies, a shared passage, nulls, empty, blank and long texts, repeated rows, clashing columns."""
    base, passage = prose(120, 1), prose(70, 99)
    near = base.split(" ")
    near[60] = "changed"
    texts = [
        (1, base), (2, base), (3, " ".join(near)), (4, prose(90, 2) + " " + passage), (5, passage + "\n" + prose(80, 3)),
        (6, None), (7, ""), (8, "   \n\t "), (9, "one two"), (10, "One Two"), (11, prose(6000, 4)), (12, "ab " * 150),
        (13, "É日本 \x00 ½ " + prose(30, 5)), (14, prose(60, 6)), (14, prose(60, 6)), (None, base), (16, "x" * 450),
    ]
    return [(i, t, f"s{(i or 0) % 3}" if i != 5 else None, 0.5, "mine") for i, t in texts]
