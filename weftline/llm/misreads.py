"""What scanning does to characters: folding, explanations of a misreading, and its simulation."""

from __future__ import annotations

import functools
import random
import re

# Characters of words as scanning misreads them (right -> read).
WORD_MISREADS = {"e": ("c",), "i": ("1", "l"), "l": ("1", "I", "i"), "o": ("0",), "s": ("5",), "g": ("9",), "b": ("6",), "d": ("cl",), "m": ("rn",), "O": ("0",), "I": ("1", "l"), "S": ("5",), "B": ("8",), "h": ("b",), "a": ("o",), "t": ("f",), "z": ("2",)}
#: The misreadings that occur by default in simulation; the others are explained but not simulated.
COMMON = {"e": ("c",), "i": ("1",), "l": ("1", "I"), "o": ("0",), "s": ("5",), "g": ("9",), "b": ("6",), "d": ("cl",), "m": ("rn",)}
# Characters of part numbers; letters in places of digits, digits in places of letters.
AS_DIGIT = str.maketrans("OQDILZSGBT", "0001125687")
AS_LETTER = str.maketrans("0125678", "OIZSGTB")
# Well-formed characters of part numbers that are read for each other.
CODE_PAIRS = frozenset("83 38 65 56 71 17 CG GC EF FE VW WV".split())
HOUSE = re.compile(r"[A-Z]{2,3}-\d{4}-\d{3}")
_DASHES = re.compile(r"[\s_~\-‐-―−­.]+")
_FOLDS = (("cl", "d"), ("rn", "m"))
_FOLD = str.maketrans({"e": "c", "0": "o", "1": "l", "i": "l", "|": "l", "5": "s", "9": "g", "6": "b", "2": "z"})


def fold(s: str) -> str:
    """A key that a text and its misreadings share."""
    s = s.lower()
    for a, b in _FOLDS:
        s = s.replace(a, b)
    return s.translate(_FOLD)


_CLASSES = str.maketrans({"e": "c", "1": "l", "i": "l", "|": "l", "0": "o", "a": "o", "5": "s", "9": "g", "6": "g", "b": "g", "h": "g", "8": "g", "t": "f", "2": "z"})


def fold_key(s: str) -> str:
    """A key that a word shares with all its misreadings of the table: characters by class, then the two sequences."""
    s = s.lower().translate(_CLASSES)
    for a, b in _FOLDS:
        s = s.replace(a, b)
    return s


@functools.lru_cache(maxsize=200_000)
def explain(read: str, right: str, most: int = 3) -> int:
    """The least number of misreadings that turn ``right`` into ``read``; ``most`` + 1 if more or impossible."""
    if abs(len(read) - len(right)) > most:
        return most + 1
    reach = {0: 0}  # position in read -> misreadings, while right is consumed
    for c in right:
        nxt: dict[int, int] = {}
        for p, n in reach.items():
            if read.startswith(c, p) and n < nxt.get(p + 1, most + 1):
                nxt[p + 1] = n
            if n < most:
                for r in WORD_MISREADS.get(c, ()):
                    if read.startswith(r, p) and n + 1 < nxt.get(p + len(r), most + 1):
                        nxt[p + len(r)] = n + 1
        reach = nxt
        if not reach:
            return most + 1
    return reach.get(len(read), most + 1)


def damage(word: str, rng: random.Random, times: int = 1) -> str:
    """A simulated misreading of a word (the word itself if none of its characters is misread)."""
    for _ in range(times):
        at = [i for i, c in enumerate(word) if c in COMMON]
        if not at:
            break
        i = rng.choice(at)
        word = word[:i] + rng.choice(COMMON[word[i]]) + word[i + 1 :]
    return word


def house_number(value: str | None) -> str | None:
    """The house part number a damaged value reads as, or None for other shapes."""
    if value is None:
        return None
    if HOUSE.fullmatch(value):
        return value
    parts = _DASHES.sub("-", value.strip()).strip("-").replace("l", "I").upper().split("-")
    if len(parts) != 3 or [len(parts[1]), len(parts[2])] != [4, 3]:
        return None
    got = f"{parts[0].translate(AS_LETTER)}-{parts[1].translate(AS_DIGIT)}-{parts[2].translate(AS_DIGIT)}"
    return got if HOUSE.fullmatch(got) else None


def code_misreads(read: str, right: str) -> int:
    """Places in which two house numbers differ, all by confusable pairs; 99 otherwise."""
    if len(read) != len(right):
        return 99
    n = 0
    for a, b in zip(read, right):
        if a != b:
            if a + b not in CODE_PAIRS:
                return 99
            n += 1
    return n
