"""The statistics of one text, written plainly: what ``text_stats.batch_statistics`` is compared with."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import lru_cache
from itertools import chain

import numpy as np

_SEGMENT = re.compile(r"[\n\t|;,•*>(){}\[\]=<\"#_/~—–:]+|[.!?。！？…、]{1,8}+(?=\s|$|[^\x00-\x7f])| (?: {2,}|[-+] )")
_END = re.compile(r"[.!?。！？](?=[\s\"'”’)»]|$|[^\x00-\x7f])")
_ITEM = re.compile(r"\s*(?:[-*•+>]\s|\(?[0-9a-z]{1,3}[.)]\s|[\w ]+\s[|=:]\s)")
_LINE_END = tuple(".!?。！？:;\"”’)")
_WIDE_GAP = re.compile(" {3,}")
_CELLS = str.maketrans("\t|", "\n\n")
_VOWELS = frozenset("aeiouyäöüáàâéèêëíìîïóòôúùûœæ")
_PLAIN = frozenset(" \t\r\n.,;:!?'\"’“”()-。、！？「」…")


_KINDS = ("alpha", "digit", "space", "upper", "symbol", "hiragana", "unspaced", "latin", "vowel")


@lru_cache
def _kinds_table() -> tuple[np.ndarray, np.ndarray]:
    """Of each character below U+10000 the number of its combination of kinds, and which kinds a combination has."""
    combinations: dict[tuple[bool, ...], int] = {}
    table = np.zeros(1 << 16, np.uint8)
    for code in range(1 << 16):
        c = chr(code)
        alpha, space = c.isalpha(), c.isspace()
        key = (
            alpha,
            c.isdigit(),
            space,
            c.isupper(),
            not c.isalnum() and not space and c not in _PLAIN,
            "\u3041" <= c <= "\u309f",
            "\u3040" <= c <= "\u30ff" or "\u4e00" <= c <= "\u9fff",
            alpha and code < 0x250,
            c.lower() in _VOWELS,
        )
        table[code] = combinations.setdefault(key, len(combinations))
    return table, np.array(list(combinations), dtype=np.int64)


def _count_kinds(text: str) -> dict[str, int]:
    """How many characters of each kind; characters beyond the basic plane count as U+FFFF does, as symbols."""
    table, has = _kinds_table()
    codes = np.minimum(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)
    return dict(zip(_KINDS, (np.bincount(table[codes], minlength=len(has)) @ has).tolist()))


def text_statistics(text: str, common: tuple[frozenset[str], ...]) -> list[float]:
    """The figures named in ``text_stats.FEATURES``. ``common`` holds one set of frequent words a language; the language of best fit counts.

    Languages written without spaces have no list: there the share of hiragana stands for the common words.
    """
    n = len(text)
    stripped = text.strip()
    if not stripped:
        return [0.0] * 16
    kinds = _count_kinds(text)
    letters, digits, upper, symbols = kinds["alpha"], kinds["digit"], kinds["upper"], kinds["symbol"]
    hiragana, unspaced, latin, vowels = kinds["hiragana"], kinds["unspaced"], kinds["latin"], kinds["vowel"]
    visible = max(n - kinds["space"], 1)
    eastern = unspaced > 0.3 * visible

    # segments between separators, and their words
    parts = [x for x in (y.strip() for y in _SEGMENT.split(text.lower()) if y) if x]
    split = [x.split() for x in parts]
    tally = Counter(chain.from_iterable(split))
    words = sum(tally.values())
    count = max(words, 1)
    if eastern:
        best: frozenset[str] = frozenset()
        share = min(1.0, 1.2 * hiragana / visible)
        word_count = max(words, unspaced // 2)
        mean_length = min(2.0 + 3 * (1 - hiragana / max(unspaced, 1)), 8.0)
    else:
        hits = [sum(filter(None, map(tally.get, c))) for c in common] or [0]
        best = common[hits.index(max(hits))] if common else frozenset()
        share = max(hits) / count
        word_count = words
        mean_length = min(sum(len(w) * c for w, c in tally.items()) / count, 40.0)

    lines = [x for x in (y.strip() for y in stripped.split("\n")) if x]
    weight = sum(map(len, lines)) or 1
    punctuated = sum(len(x) for x in lines if x.endswith(_LINE_END)) / weight
    items = sum(len(x) for x in lines if _ITEM.match(x)) / weight

    # segments of several words with enough common ones run on as language does
    running = total = repeated = 0
    seen: set[str] = set()
    for part, ws in zip(parts, split):
        size = len(part)
        total += size
        if part in seen:
            repeated += size
        else:
            seen.add(part)
        if eastern:
            if size >= 6 and sum("\u3041" <= c <= "\u309f" for c in part) >= 0.2 * size:
                running += size
        elif len(ws) >= 4 and sum(map(best.__contains__, ws)) >= 0.2 * len(ws):
            running += size
    gapless = _WIDE_GAP.sub("\n", stripped) if "   " in stripped else stripped
    cells = gapless.translate(_CELLS).split("\n") if "\t" in gapless or "|" in gapless else gapless.split("\n")
    wide = sum(len(x) for x in cells if (len(x) >= 24 if eastern else x.count(" ") >= 9))
    raw = text.encode("utf-8", "surrogatepass")
    return [
        float(np.log1p(word_count)),
        mean_length,
        symbols / visible,
        digits / visible,
        punctuated,
        share,
        running / max(total, 1),
        min(len(_END.findall(text)) / max(word_count, 1) * 10, 3.0),
        vowels / latin if latin > 0.3 * visible else 0.38,
        upper / letters if letters > 0.3 * visible and not eastern else 0.05,
        sum(c for w, c in tally.items() if len(w) == 1 and w.isalpha()) / count if not eastern else 0.05,
        min(len(zlib.compress(raw, 1)) / max(len(raw), 40), 1.2),
        repeated / max(total, 1),
        float(np.log1p(n / max(len(lines), 1))),
        items,
        wide / max(sum(map(len, cells)), 1),
    ]
