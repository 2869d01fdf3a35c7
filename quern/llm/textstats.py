"""Per-document text statistics that tell prose from lists, tables and junk
(problem 8).

A document is cut into chunks; each chunk gives associative partial counts. The
lines wholly inside a chunk are judged there. The pieces of lines (and words)
that a cut may have broken are carried as boundary state: their counts and a
few characters, never their text. Partials merge in a tree, and the ratios and
rule outcomes are derived from the merged counts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.session import settle

#: Longest chunk in characters; longer documents are counted in pieces.
CHUNK = 1 << 16
#: Partials merged by one task at one level of the tree.
FAN_IN = 64

# Frequent function words of English and function characters of
# Chinese; characters common in names (和, 与, 学 and the like) are left out.
ENGLISH_COMMON = frozenset(
    "a about after all also an and any are as at be because been before but by can did do does each few for from had has have"
    " he her his how i if in into is it its just may more most my no not now of on only or other our out over she should so some"
    " such than that the their them then there these they this those through to too under up us was we were what when where which"
    " while who will with would you your".split()
)
CHINESE_COMMON = "的了是在我也都就这那把被会要很不没还又从对他她们后来去只其最再时可以你说看有得着过吗呢吧给让向跟比已或但而且因为所如果虽然怎么什"

# Exclusive character classes.
SPACE, NEWLINE, HAN, FUNC, RARE, CONS, VOWEL, DIGIT, STOP, COMMA, LISTED, PIPE, TAB, ANGLE, PAIR, SIGN, FOREIGN, SEMI = range(18)
CLASSES = 18
# A fragment's numbers: the classes, then English words, common English words,
# repeats of the character before, runs of two blanks or more.
WORDS, COMMON, REPEAT, GAPS = range(CLASSES, CLASSES + 4)
WIDTH = CLASSES + 4

_ENGLISH = re.compile(r"[A-Za-z]+")
_LONGEST_COMMON = max(map(len, ENGLISH_COMMON))
_VISIBLE_END = " \u3000\xa0\r\x0b\x0c\t"


@lru_cache(maxsize=1)
def classes() -> np.ndarray:
    """Class of every character of the first plane."""
    lut = np.full(0x10000, SIGN, np.uint8)
    for cp in range(0x80, 0x10000):
        if not 0xD800 <= cp < 0xE000 and chr(cp).isalpha():
            lut[cp] = FOREIGN
    for cp in range(0x3400, 0xA000):
        lut[cp] = RARE
    for hi in range(0xB0, 0xF8):  # the ideographs of GB 2312 are the common ones
        for lo in range(0xA1, 0xFF):
            try:
                lut[ord(bytes((hi, lo)).decode("gb2312"))] = HAN
            except UnicodeDecodeError:
                pass
    for c in CHINESE_COMMON:
        lut[ord(c)] = FUNC
    for c in range(ord("a"), ord("z") + 1):
        k = VOWEL if chr(c) in "aeiou" else CONS
        lut[c] = lut[c - 32] = k
    for chars, k in (("0123456789０１２３４５６７８９", DIGIT), ("。！？.!?…", STOP), ("，,：:", COMMA), ("、", LISTED), ("|｜", PIPE), ("\t", TAB), ("<>", ANGLE), ("；;", SEMI), ("()（）[]【】“”\"'‘’《》「」%％-—~", PAIR), ("\n", NEWLINE), (" 　\xa0\r\x0b\x0c", SPACE)):
        for c in chars:
            lut[ord(c)] = k
    return lut


@lru_cache(maxsize=1)
def common_codes() -> np.ndarray:
    """The common English words as numbers, five bits a letter."""
    return np.array(sorted(sum((ord(c) - 96) << 5 * k for k, c in enumerate(w)) for w in ENGLISH_COMMON), np.int64)


def latin_words(codes: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places where runs of Latin letters begin, whether each is a common word)."""
    edges = np.diff(letter.astype(np.int8), prepend=0, append=0)
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    short = np.flatnonzero(end - begin <= _LONGEST_COMMON)
    word = np.zeros(len(short), np.int64)
    for k in range(_LONGEST_COMMON):
        at = begin[short] + k
        inside = at < end[short]
        word[inside] |= ((codes[at[inside]].astype(np.int64) | 32) - 96) << 5 * k
    common = np.zeros(len(begin), bool)
    common[short] = np.isin(word, common_codes())
    return begin, common


def fragments(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts per line of all texts, vectorised over the whole batch: (index of
    each line's text, counts, whether it ends in sentence punctuation)."""
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lut = classes()
    cls = np.where(codes < 0x10000, lut[np.minimum(codes, 0xFFFF)], np.where((codes >= 0x20000) & (codes < 0x32000), RARE, SIGN).astype(np.uint8))
    breaks = np.flatnonzero(cls == NEWLINE)
    starts = np.concatenate(([0], breaks + 1))
    ends = np.concatenate((breaks, [len(codes)]))
    lines = len(starts)
    line_of = np.repeat(np.arange(lines), np.diff(np.concatenate((starts, [len(codes)]))))
    counts = np.zeros((lines, WIDTH), np.int64)
    if len(codes):
        counts[:, :CLASSES] = np.bincount(line_of * CLASSES + cls, minlength=lines * CLASSES).reshape(lines, CLASSES)
        again = np.zeros(len(codes), bool)
        again[1:] = (codes[1:] == codes[:-1]) & (cls[1:] != NEWLINE) & (cls[1:] != SPACE)
        counts[:, REPEAT] = np.bincount(line_of[again], minlength=lines)
        blank = (cls == SPACE) | (cls == TAB)
        gap = np.zeros(len(codes), bool)
        gap[1:] = blank[1:] & blank[:-1]
        gap[2:] &= ~blank[:-2]
        counts[:, GAPS] = np.bincount(line_of[gap], minlength=lines)
        begin, common = latin_words(codes, (cls == CONS) | (cls == VOWEL))
        counts[:, WORDS] = np.bincount(line_of[begin], minlength=lines)
        counts[:, COMMON] = np.bincount(line_of[begin[common]], minlength=lines)
    counts[:, NEWLINE] = 0
    lengths = np.fromiter((len(t) for t in texts), np.int64, len(texts))
    first_at = np.concatenate(([0], np.cumsum(lengths + 1)[:-1])) if len(texts) else np.zeros(0, np.int64)
    owner = np.searchsorted(first_at, starts, "right") - 1
    # the last visible character of each line
    seen = np.where((cls == SPACE) | (cls == TAB) | (cls == NEWLINE), -1, np.arange(len(codes)))
    last = np.maximum.accumulate(seen)[np.maximum(ends - 1, 0)] if len(codes) else np.full(lines, -1)
    closed = (last >= starts) & (ends > starts) & np.isin(cls[np.maximum(last, 0)] if len(codes) else np.zeros(lines), (STOP,))
    return owner, counts, closed


def is_prose(counts: np.ndarray) -> np.ndarray:
    """Whether each line's counts are those of natural prose.

    Prose has its language's function words: at least one function character
    in forty ideographs, or common words for an eighth of the words. Rows of
    separators or tags, odd signs, foreign or rare characters, and runs of one
    character aren't prose whatever their words."""
    c = counts
    han = c[:, HAN] + c[:, FUNC] + c[:, RARE]
    latin = c[:, CONS] + c[:, VOWEL]
    visible = c[:, :CLASSES].sum(1) - c[:, SPACE] - c[:, TAB]
    chinese = (han >= latin) & (han >= 2) & (c[:, RARE] * 10 <= han) & (c[:, FUNC] * 40 >= han)
    english = (han < latin) & (c[:, WORDS] >= 3) & (c[:, COMMON] * 8 >= c[:, WORDS])
    # menus and the like: separators or gaps, but no punctuation of sentences
    menu = (c[:, STOP] + c[:, COMMA] == 0) & (c[:, GAPS] + c[:, ANGLE] + c[:, PIPE] + c[:, SIGN] >= 1)
    odd = menu | (c[:, PIPE] >= 2) | (c[:, TAB] >= 2) | (c[:, ANGLE] >= 4) | (c[:, SIGN] * 20 > 3 * visible) | (c[:, REPEAT] * 5 > 2 * visible) | (c[:, FOREIGN] * 10 > 3 * visible)
    return (chinese | english) & ~odd


# A document's numbers: the line counts summed, then lines with visible
# characters, lines closed by punctuation, and characters outside prose lines.
LINES, CLOSED, APART = range(WIDTH, WIDTH + 3)
TOTAL = WIDTH + 3


def judged(counts: np.ndarray, closed: np.ndarray) -> np.ndarray:
    """Counts of whole lines with their verdicts, ready to be summed."""
    chars = counts[:, :CLASSES].sum(1)
    visible = chars - counts[:, SPACE] - counts[:, TAB] > 0
    return np.column_stack((counts, visible, visible & closed, np.where(is_prose(counts), 0, chars)))


def whole_texts(texts: list[str]) -> np.ndarray:
    """Totals of each text (rows of TOTAL numbers)."""
    owner, counts, closed = fragments(texts)
    out = np.zeros((len(texts), TOTAL), np.int64)
    rows = judged(counts, closed)
    if len(owner):  # lines come in the order of their texts
        at = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[at]] = np.add.reduceat(rows, at, axis=0)
    return out


# --- partial counts of chunks -------------------------------------------------

_KEEP = 24  # no common word is as long; longer pieces only count as words


class Fragment:
    """A piece of one line: counts and what its ends look like.

    ``merge`` is associative: counts add up, then what the cut distorted is put
    right: a word or a run of blanks in two pieces counts once, a character
    equal to the one before counts as a repeat."""

    __slots__ = ("counts", "edge", "last")

    def __init__(self, counts: np.ndarray, edge: str, last: str):
        self.counts = counts
        self.edge = edge  # the whole piece up to 4 * _KEEP, else both its ends
        self.last = last  # its last visible character

    @classmethod
    def of(cls, text: str) -> Fragment:
        _, counts, _ = fragments([text])
        return cls(counts[0], cls.ends(text), text.rstrip(_VISIBLE_END)[-1:])

    @staticmethod
    def ends(text: str) -> str:
        return text if len(text) <= 4 * _KEEP else text[: 2 * _KEEP] + "\n" + text[-2 * _KEEP :]

    def merge(self, other: Fragment) -> Fragment:
        if not self.edge:
            return other
        if not other.edge:
            return self
        counts = self.counts + other.counts
        left, right = self.edge[-2 * _KEEP :].split("\n")[-1], other.edge[: 2 * _KEEP].split("\n")[0]
        _, both, _ = fragments([left + right])
        _, a, _ = fragments([left])
        _, b, _ = fragments([right])
        for k in (REPEAT, GAPS):
            counts[k] += both[0, k] - a[0, k] - b[0, k]
        for k, some in ((WORDS, lambda w: True), (COMMON, lambda w: w.lower() in ENGLISH_COMMON)):
            n = lambda t: sum(some(w) for w in _ENGLISH.findall(t))  # noqa: B023, E731
            counts[k] += n(left + right) - n(left) - n(right)
        full = "\n" not in self.edge and "\n" not in other.edge and len(self.edge) + len(other.edge) <= 4 * _KEEP
        if full:
            return Fragment(counts, self.edge + other.edge, other.last or self.last)
        head = self.edge[: 2 * _KEEP].split("\n")[0]
        head = head if len(head) >= 2 * _KEEP or "\n" in self.edge else (self.edge + other.edge.split("\n")[0])[: 2 * _KEEP]
        tail = other.edge[-2 * _KEEP :].split("\n")[-1]
        tail = tail if len(tail) >= 2 * _KEEP or "\n" in other.edge else (self.edge.split("\n")[-1] + other.edge)[-2 * _KEEP :]
        return Fragment(counts, head + "\n" + tail, other.last or self.last)

    def line(self) -> np.ndarray:
        """The totals of this piece as a whole line."""
        closed = bool(self.last) and ord(self.last) < 0x10000 and classes()[ord(self.last)] == STOP
        return judged(self.counts[None, :], np.array([closed]))[0]


class Partial:
    """Counts of a stretch of a document: the totals of the lines whole inside
    it and the pieces of lines at both ends (one piece if it has no break)."""

    __slots__ = ("inner", "head", "tail")

    def __init__(self, inner: np.ndarray, head: Fragment, tail: Fragment | None):
        self.inner, self.head, self.tail = inner, head, tail

    @classmethod
    def of(cls, text: str) -> Partial:
        a, b = text.find("\n"), text.rfind("\n")
        if a < 0:
            return cls(np.zeros(TOTAL, np.int64), Fragment.of(text), None)
        inner = whole_texts([text[a + 1 : b]])[0] if b > a else np.zeros(TOTAL, np.int64)
        return cls(inner, Fragment.of(text[:a]), Fragment.of(text[b + 1 :]))

    def merge(self, other: Partial) -> Partial:
        if self.tail is None:
            return Partial(other.inner, self.head.merge(other.head), other.tail)
        if other.tail is None:
            return Partial(self.inner, self.head, self.tail.merge(other.head))
        return Partial(self.inner + other.inner + self.tail.merge(other.head).line(), self.head, other.tail)

    def totals(self) -> np.ndarray:
        return self.inner + self.head.line() + (self.tail.line() if self.tail is not None else 0)


def _pack(p: Partial) -> dict:
    return {
        "inner": p.inner.tolist(), "head": p.head.counts.tolist(), "head_edge": p.head.edge, "head_last": p.head.last,
        "tail": None if p.tail is None else p.tail.counts.tolist(), "tail_edge": None if p.tail is None else p.tail.edge, "tail_last": None if p.tail is None else p.tail.last,
    }


def _unpack(r) -> Partial:
    tail = None if r.tail is None else Fragment(np.asarray(r.tail, np.int64), r.tail_edge, r.tail_last)
    return Partial(np.asarray(r.inner, np.int64), Fragment(np.asarray(r.head, np.int64), r.head_edge, r.head_last), tail)


_STATE = "inner array<long>, head array<long>, head_edge string, head_last string, tail array<long>, tail_edge string, tail_last string"
_STATS = "n_chars long, word_count long, mean_word_length double, symbol_ratio double, punct_line_share double, common_word_share double, apart_share double, kind string"


def derive(totals: np.ndarray) -> pd.DataFrame:
    """Ratios and the rule outcome from totals; a blank text has no ratios."""
    t = totals
    han = t[:, HAN] + t[:, FUNC] + t[:, RARE]
    latin = t[:, CONS] + t[:, VOWEL]
    chars = t[:, :CLASSES].sum(1)
    visible = chars - t[:, SPACE] - t[:, TAB]
    english, common = t[:, WORDS], t[:, COMMON]
    words = han + english
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = lambda a, b: np.where(b > 0, np.floor(a / b * 1e6 + 0.5) / 1e6, np.nan)
        apart = ratio(t[:, APART], chars)
        out = pd.DataFrame({
            "n_chars": chars, "word_count": words,
            "mean_word_length": ratio(han + np.where(english > 0, latin, 0), words),
            "symbol_ratio": ratio(t[:, SIGN] + t[:, ANGLE] + t[:, PIPE], visible),
            "punct_line_share": ratio(t[:, CLOSED], t[:, LINES]),
            "common_word_share": ratio(t[:, FUNC] + common, words),
            "apart_share": apart,
        })
    out["kind"] = np.where(visible == 0, "blank", np.where(t[:, APART] * 2 > chars, "apart", "prose"))
    return out


def _slices(texts: list[str], limit: int = 2_000_000) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts have about ``limit`` characters together."""
    a = n = 0
    for i, t in enumerate(texts):
        if n and n + len(t) > limit:
            yield a, i
            a, n = i, 0
        n += len(t)
    if a < len(texts):
        yield a, len(texts)


def text_statistics(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK, fan_in: int = FAN_IN) -> DataFrame:
    """One row of statistics per row of ``docs``.

    kind is ``prose``, ``apart`` (more than half of the characters stand in
    lines that aren't natural prose) or ``blank``. A word is a run of Latin
    letters or one ideograph. NULL and blank texts have no words and no ratios
    (NULL). Repeated rows and ids give repeated rows; other columns are
    ignored. The texts are read once: each is cut into chunks of up to ``chunk``
    characters, a text of one chunk is done there, the partial counts of the
    others merge in a tree, ``fan_in`` at a time.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    base = docs.select(F.col(doc_id), F.coalesce(F.col(text), F.lit("")).alias("_t")).withColumn("_row", F.monotonically_increasing_id())
    parts = F.when(F.length("_t") <= chunk, F.array("_t")).otherwise(F.regexp_extract_all("_t", F.lit(f"(?s).{{1,{chunk}}}"), 0))
    cut = base.select(doc_id, "_row", parts.alias("_parts")).select(doc_id, "_row", F.size("_parts").alias("_of"), F.posexplode("_parts").alias("_at", "_part"))
    state_fields = [f.split(" ")[0] for f in _STATE.split(", ")]

    def filled(pdf: pd.DataFrame) -> pd.DataFrame:
        for c in columns:
            if c not in pdf.columns:
                pdf[c] = pd.Series([None] * len(pdf), index=pdf.index, dtype=object)
        return pdf[columns]

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            alone = pdf["_of"] == 1
            texts = pdf["_part"][alone].tolist()
            keys = pdf[[doc_id, "_row", "_at", "_of"]]
            for a, b in _slices(texts):
                out = derive(whole_texts(texts[a:b]))
                out.index = keys.index[alone][a:b]
                yield filled(pd.concat([keys[alone].iloc[a:b], out], axis=1))
            if not alone.all():
                states = pd.DataFrame([_pack(Partial.of(s)) for s in pdf["_part"][~alone]], index=keys.index[~alone])
                yield filled(pd.concat([keys[~alone], states], axis=1))

    counted_schema = f"{doc_id} {kind}, _row long, _at int, _of int, {_STATS}, {_STATE}"
    columns = [doc_id, "_row", "_at", "_of", *[f.split(" ")[0] for f in _STATS.split(", ")], *state_fields]
    counted = settle(cut.mapInPandas(count, counted_schema), "text-counts")
    names = [f.split(" ")[0] for f in _STATS.split(", ")]
    short = counted.where("_of = 1").select(doc_id, *names)
    pieces = counted.agg(F.max("_of")).first()[0] or 0
    if pieces <= 1:
        return short
    partial_schema = f"{doc_id} {kind}, _row long, _at int, {_STATE}"
    partials = counted.where("_of > 1").select(doc_id, "_row", "_at", *state_fields)

    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_at")
        states = [_unpack(r) for r in pdf.itertuples()]
        whole = states[0]
        for s in states[1:]:
            whole = whole.merge(s)
        return pd.DataFrame([{doc_id: pdf[doc_id].iloc[0], "_row": pdf["_row"].iloc[0], "_at": pdf["_at"].iloc[0] // fan_in} | _pack(whole)])

    while pieces > 1:
        partials = partials.groupBy("_row", F.expr(f"_at div {fan_in}").alias("_up")).applyInPandas(merge, partial_schema)
        pieces = -(-pieces // fan_in)

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                out = derive(np.array([_unpack(r).totals() for r in pdf.itertuples()], np.int64))
                out.insert(0, doc_id, pdf[doc_id].to_numpy())
                yield out

    return short.unionByName(partials.mapInPandas(finish, f"{doc_id} {kind}, {_STATS}"))
