"""Evaluation texts leaking into training text (problem 7).

Texts are compared as their letters and digits alone (width and case folded).

1. Every n-gram of the test items is hashed; a Bloom filter of those hashes is
   built in Spark. Its size is bounded, whatever the number of items.
2. One pass over the corpus hashes the n-gram at every place and keeps the
   places that pass the filter. Only those are shuffled.
3. Seeds: in every stretch of an item the n-grams of the rarest class, by how
   often they occur in corpus and items. They join corpus places to items.
4. Smith-Waterman alignment scores each pair around all its seeds, in the texts
   of the pairs alone; the longest unbroken run is measured beside it.

Equal texts and equal items are searched once and spread to their rows at the end.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import settle

#: Shortest unbroken run that counts as a leak, in letters and digits.
RUN = 40
#: Weight of an n-gram: an ideograph, kana or hangul counts 2, any other letter 1.
WEIGHT = 16
#: Starts in a stretch of an item. A run of RUN letters holds at least
#: RUN - WEIGHT + 1 starts, hence a whole stretch and with it a seed.
STRETCH = 12
#: Bits of the filter: so many a hash, at most 2 ** BLOOM_MOST (64 MB). Beyond
#: that it lets more places through, which the join then drops.
BLOOM_BITS, BLOOM_LEAST, BLOOM_MOST, BLOOM_PROBES = 64, 18, 29, 4
#: Hashes of the texts of candidate pairs are broadcast up to this many (1.6 MB),
#: beyond it a filter of them goes ahead of a shuffled join.
HASHES_SENT = 100_000
#: Characters that a task works on at once; a longer text is taken in pieces.
PIECE = 2_000_000
#: Most diagonals on either side of a seed that an alignment may reach.
REACH = 4000
#: Half the width of the first, narrow alignment.
NARROW = 16
#: Scores of the alignment.
MATCH, MISMATCH, GAP = 2, -2, -3
#: Share of an item's best possible score that makes an edited copy.
EDITED_SHARE = 0.5

_MANY = 0xFFFFFFFF


def fold_char(ch: str) -> str:
    """Letters and digits of a character, width, case and accents folded."""
    s = unicodedata.normalize("NFKC", ch).casefold()
    if not ("가" <= ch <= "힣"):
        s = unicodedata.normalize("NFKD", s)
    return "".join(c for c in s if c.isalnum())


@lru_cache(maxsize=1)
def _folds() -> tuple[np.ndarray, dict[int, str]]:
    lut = np.zeros(0x10000, np.uint32)
    many = {}
    for cp in range(0x10000):
        if 0x4E00 <= cp < 0xA000:
            lut[cp] = cp
            continue
        f = fold_char(chr(cp)) if not 0xD800 <= cp < 0xE000 else ""
        if len(f) == 1:
            lut[cp] = ord(f)
        elif f:
            lut[cp] = _MANY
            many[cp] = f
    return lut, many


def fold_text(s: str) -> str:
    return "".join(fold_char(c) for c in s)


def fold_batch(texts: list[str]) -> np.ndarray:
    """The folded characters of all texts, vectorised, 1 between two texts."""
    lut, _ = _folds()
    joined = "\x01".join(t.replace("\x01", " ") if "\x01" in t else t for t in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    beyond = codes >= 0x10000
    out = lut[np.where(beyond, 0, codes)]
    out[codes == 1] = 1
    hard = beyond | (out == _MANY)
    places = np.flatnonzero(hard)
    if len(places):  # rare: characters of several letters, or beyond the first plane
        swap = {c: np.array([ord(x) for x in fold_char(chr(c))], np.uint32) for c in np.unique(codes[places]).tolist()}
        pieces, at = [], 0
        for i, c in zip(places.tolist(), codes[places].tolist()):
            pieces += [out[at:i], swap[c]]
            at = i + 1
        out = np.concatenate([*pieces, out[at:]])
    return out[out > 0].astype(np.uint32)


def fold_texts(texts: list[str]) -> list[str]:
    """``fold_text`` of every text."""
    if len(texts) == 1 and len(texts[0]) > PIECE:
        return ["".join(fold_texts([texts[0][a : a + PIECE]])[0] for a in range(0, len(texts[0]), PIECE))]
    return decode(fold_batch(texts)).split("\x01") if texts else []


def decode(codes: np.ndarray) -> str:
    return codes.tobytes().decode("utf-32-le", "surrogatepass")


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def weights(codes: np.ndarray) -> np.ndarray:
    """2 for characters that stand for a syllable or a word, 1 for others."""
    heavy = ((codes >= 0x3040) & (codes < 0xA000)) | ((codes >= 0xAC00) & (codes < 0xD7B0)) | ((codes >= 0xF900) & (codes < 0xFB00)) | (codes >= 0x20000)
    return heavy.astype(np.int64) + 1


def gram_hashes(codes: np.ndarray, weight: int = WEIGHT) -> tuple[np.ndarray, np.ndarray]:
    """(hash, end) of the n-gram at every place that has one.

    An n-gram is the shortest piece that weighs ``weight`` or more, so it hangs
    on nothing but the characters themselves. Equal n-grams have equal hashes
    wherever they stand; a prefix sum modulo 2^64 gives all of them in one go.
    """
    n = len(codes)
    total = np.zeros(n + 1, np.int64)
    np.cumsum(weights(codes), out=total[1:])
    # first place at which a total weight is reached; of weight 2, two totals are
    first = np.empty(total[-1] + 1, np.int64)
    first[total[1:] - 1] = np.arange(1, n + 1)
    first[total] = np.arange(n + 1)
    starts = int(np.searchsorted(total, total[-1] - weight, "right"))
    ends = first[total[:starts] + weight]
    return _hashes(codes, np.arange(starts), ends), ends


def _hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(codes)
    up, down = _powers(max(n, 1))
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((codes.astype(np.uint64) + np.uint64(7)) * down[:n], out=sums[1:])
    h = (sums[ends] - sums[starts]) * up[starts]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def length_hashes(codes: np.ndarray, length: int) -> np.ndarray:
    """Hash of the piece of ``length`` characters at every place."""
    starts = np.arange(max(0, len(codes) - length + 1))
    return _hashes(codes, starts, starts + length)


#: Cells that one step of a batch of alignments works on.
_CELLS = 1 << 17


def align_between(pairs: list[tuple[str, str, int, int]]) -> list[int]:
    """Smith-Waterman scores of (item, text, lowest diagonal, highest diagonal),
    in batches of pairs of like width."""
    out = [0] * len(pairs)
    order = sorted(range(len(pairs)), key=lambda i: pairs[i][3] - pairs[i][2])
    at = 0
    while at < len(order):
        end = at + 1
        while end < len(order) and (pairs[order[end]][3] - pairs[order[end]][2] + 1) * (end + 1 - at) <= _CELLS:
            end += 1
        for i, x in zip(order[at:end], _align_batch([pairs[i] for i in order[at:end]])):
            out[i] = x
        at = end
    return out


def _align_batch(pairs: list[tuple[str, str, int, int]]) -> list[int]:
    """All pairs at once: one row of the item a step, pairs side by side."""
    rows = max(len(a) for a, *_ in pairs)
    width = max(hi - lo for _, _, lo, hi in pairs) + 1
    n = len(pairs)
    item = np.zeros((rows, n), np.uint32)
    window = np.full((rows + width, n), 0xFFFFFFFF, np.uint32)
    for i, (a, b, lo, hi) in enumerate(pairs):
        item[: len(a), i] = np.frombuffer(a.encode("utf-32-le"), np.uint32)
        piece = b[max(lo, 0) : max(lo + rows + width, 0)]
        if piece:
            at = max(-lo, 0)
            window[at : at + len(piece), i] = np.frombuffer(piece.encode("utf-32-le"), np.uint32)
    kind = np.int16 if MATCH * rows - GAP * width < 30_000 else np.int32
    h = np.zeros((width, n), kind)
    best = np.zeros(n, kind)
    slide = (np.arange(width) * -GAP).astype(kind)[:, None]
    same, score, up, zero = np.empty((width, n), bool), np.empty((width, n), kind), np.empty((width - 1, n), kind), np.zeros((width, n), kind)
    for r in range(rows):
        np.add(h[1:], kind(GAP), out=up)
        np.equal(item[r], window[r : r + width], out=same)
        np.multiply(same, kind(MATCH - MISMATCH), out=score)
        h += score
        h += kind(MISMATCH)
        np.maximum(h[:-1], up, out=h[:-1])
        np.maximum(h, zero, out=h)
        # a gap in the item, for the whole row at once: a running maximum by doubling
        h += slide
        step = 1
        while step < width:
            h[step:] = np.maximum(h[step:], h[:-step])
            step *= 2
        h -= slide
        np.maximum(best, h.max(axis=0), out=best)
    return best.tolist()


def band_reach(length: int) -> int:
    """How far an alignment of an item may leave its seed's diagonal: gaps cost
    more than the item's matches can bring beyond it; REACH at most."""
    return min(MATCH * length // -GAP, REACH)


def bands(diagonals: list[int], reach: int) -> list[tuple[int, int]]:
    """Ranges of diagonals that hold ``reach`` on either side of each."""
    out: list[tuple[int, int]] = []
    for d in sorted(diagonals):
        if out and d - reach <= out[-1][1]:
            out[-1] = (out[-1][0], d + reach)
        else:
            out.append((d - reach, d + reach))
    return out


def seeded_scores(pairs: list[tuple[str, str, list[int]]], least: list[int]) -> list[int]:
    """Best alignment score of each (item, text, diagonals of seeds), or 0 where
    it can't reach ``least``.

    A narrow alignment goes first. One of score S that leaves the narrow band k
    times pays at least g = NARROW * -GAP each time, so its pieces sum to
    S + k * g and the best of them has g or more (where S has); a pair whose
    narrow score is below both g and its ``least`` is given up."""

    def over(which: list[int], reach) -> dict[int, int]:
        spans = [(k, lo, hi) for k in which for lo, hi in bands(pairs[k][2], reach(len(pairs[k][0])))]
        best: dict[int, int] = {}
        for (k, _, _), x in zip(spans, align_between([(pairs[k][0], pairs[k][1], lo, hi) for k, lo, hi in spans])):
            best[k] = max(x, best.get(k, 0))
        return best

    narrow = over(range(len(pairs)), lambda n: min(NARROW, band_reach(n)))
    full = over([k for k, x in narrow.items() if x >= min(NARROW * -GAP, least[k])], band_reach)
    return [x if (x := full.get(k, 0)) >= least[k] else 0 for k in range(len(pairs))]


def longest_run(item: np.ndarray, text: np.ndarray, diagonals: list[int]) -> int:
    """Length of the longest unbroken common run on the given diagonals."""
    best = 0
    for d in diagonals:
        lo, hi = max(0, -d), min(len(item), len(text) - d)
        if hi - lo <= best:
            continue
        breaks = np.flatnonzero(item[lo:hi] != text[lo + d : hi + d])
        edges = np.concatenate(([-1], breaks, [hi - lo]))
        best = max(best, int(np.diff(edges).max()) - 1)
    return best


def _codes(s: str) -> np.ndarray:
    return np.frombuffer(s.encode("utf-32-le", "surrogatepass"), np.uint32)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Index ranges whose texts have about PIECE characters together."""
    a = n = 0
    for i, t in enumerate(texts):
        if n and n + len(t) > PIECE:
            yield a, i
            a, n = i, 0
        n += len(t)
    if a < len(texts):
        yield a, len(texts)


def _probe(h: Column, k: int, bits: int) -> Column:
    """Place of a hash's k-th bit (``_passes`` does the same in numpy)."""
    mask = F.lit((1 << bits) - 1)
    step = F.shiftright(h, 33).bitwiseAND(mask).bitwiseOR(F.lit(1))
    return (h.bitwiseAND(mask) + step * F.lit(k)).bitwiseAND(mask)


def bloom(hashes: DataFrame, column: str, n: int) -> tuple[bytes, int]:
    """(bitmap, its size as a power of two) of a column of ``n`` 64-bit hashes.

    The pieces of the bitmap are built and merged in Spark; at most
    2 ** BLOOM_MOST bits come to the driver, however many hashes there are.
    """
    bits = min(BLOOM_MOST, max(BLOOM_LEAST, (n * BLOOM_BITS).bit_length()))
    at = F.explode(F.array(*[_probe(F.col(column), k, bits) + 1 for k in range(BLOOM_PROBES)]))
    pieces = hashes.select(at.alias("b")).groupBy(F.bitmap_bucket_number("b").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("b")).alias("m"))
    out = np.zeros(max(1 << (bits - 3), 4096), np.uint8)
    for r in pieces.toLocalIterator():
        lo = (int(r["k"]) - 1) * 4096  # buckets of 32768 bits, counted from 1
        out[lo : lo + 4096] |= np.frombuffer(bytes(r["m"]), np.uint8)[: len(out) - lo]
    return out.tobytes(), bits


def _passes(h: np.ndarray, bitmap: np.ndarray, bits: int) -> np.ndarray:
    """Places in ``h`` (int64) whose hash may be in the filter."""
    at = None
    mask = np.int64((1 << bits) - 1)
    for k in range(BLOOM_PROBES):
        x = h if at is None else h[at]
        step = ((x >> np.int64(33)) & mask) | np.int64(1)
        b = ((x & mask) + step * np.int64(k)) & mask
        hit = (bitmap[b >> 3] >> (b & 7).astype(np.uint8)) & 1
        at = np.flatnonzero(hit) if at is None else at[hit.astype(bool)]
    return at


def item_grams(kinds: DataFrame) -> DataFrame:
    """(h, i, p, stretch, size) of every n-gram of the items (i, s).

    An item lighter than an n-gram is one n-gram of its own ``size``; size is 0
    for all others."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for i, s in zip(pdf["i"], pdf["s"]):
                codes = _codes(s)
                h, _ = gram_hashes(codes) if weights(codes).sum() >= WEIGHT else (length_hashes(codes, len(codes)), None)
                p = np.arange(len(h), dtype=np.int32)
                size = 0 if weights(codes).sum() >= WEIGHT else len(codes)
                yield pd.DataFrame({"h": h.view(np.int64), "i": i, "p": p, "stretch": p // STRETCH, "size": np.int32(size)})

    return kinds.select("i", "s").mapInPandas(cut, "h long, i long, p int, stretch int, size int")


Filters = dict[int, tuple[np.ndarray, int]]


def found_places(codes: np.ndarray, maps: Filters, behind: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, places) of the n-grams that pass their size's filter and don't
    end within the first ``behind`` characters."""
    hs, at = [], []
    for size, (m, bits) in maps.items():
        if size:
            h = length_hashes(codes, size)
            ends = np.arange(len(h)) + size
        else:
            h, ends = gram_hashes(codes)
        h = h.view(np.int64)
        found = _passes(h, m, bits)
        found = found[ends[found] > behind]
        hs.append(h[found])
        at.append(found)
    return np.concatenate(hs), np.concatenate(at)


def long_text_places(text: str, maps: Filters) -> tuple[np.ndarray, np.ndarray]:
    """``found_places`` of a text taken in pieces that share an n-gram's length."""
    hs, at, done, kept = [], [], 0, np.zeros(0, np.uint32)
    for a in range(0, len(text), PIECE):
        codes = np.concatenate((kept, fold_batch([text[a : a + PIECE]])))
        h, places = found_places(codes, maps, len(kept))
        hs.append(h)
        at.append(places + done)
        done += len(codes)
        kept = codes[-(WEIGHT - 1) :]
        done -= len(kept)
    return np.concatenate(hs), np.concatenate(at)


def corpus_places(docs: DataFrame, doc_id: str, text: str, filters: dict[int, tuple[bytes, int]]) -> DataFrame:
    """(doc_id, t1, t2, hs, at): of every document with any, the n-grams that
    pass the filter, and where. ``filters`` has one for each size of n-gram."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(filters)
    kind = docs.schema[doc_id].dataType.simpleString()

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        maps = {size: (np.frombuffer(m, np.uint8), bits) for size, (m, bits) in shared.value.items()}
        for pdf in batches:
            texts = pdf[text].tolist()
            for lo, hi in _slices(texts):
                if hi - lo == 1 and len(texts[lo]) > PIECE:
                    (h, places), begins = long_text_places(texts[lo], maps), np.zeros(1, np.int64)
                else:
                    codes = fold_batch(texts[lo:hi])
                    begins = np.concatenate(([0], np.flatnonzero(codes == 1) + 1))
                    h, places = found_places(codes, maps)
                doc = np.searchsorted(begins, places, "right") - 1
                order = np.argsort(doc, kind="stable")
                h, places, doc = h[order], places[order], doc[order]
                own, first = np.unique(doc, return_index=True)
                if len(own):
                    rows = pdf.iloc[own + lo][[doc_id, "t1", "t2"]].reset_index(drop=True)
                    rows["hs"] = np.split(h, first[1:])
                    rows["at"] = np.split((places - begins[doc]).astype(np.int32), first[1:])
                    yield rows

    return docs.select(doc_id, "t1", "t2", text).mapInPandas(search, f"{doc_id} {kind}, t1 long, t2 long, hs array<long>, at array<int>")


def seeds(grams: DataFrame, places: DataFrame) -> DataFrame:
    """(h, i, p): in every stretch of an item, of the n-grams that occur in the
    corpus, all of the rarest class. Classes are powers of two of occurrences
    times items, so that a copy with a few n-grams more or less changes none."""
    from pyspark.sql import Window

    n = places.select(F.explode("hs").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n"))
    k = grams.groupBy("h").agg(F.count(F.lit(1)).alias("k"))
    cost = n.join(k, "h").select("h", F.floor(F.log2(F.col("n") * F.col("k"))).cast("int").alias("cost"))
    least = F.min("cost").over(Window.partitionBy("i", "stretch"))  # STRETCH rows at most
    return grams.join(cost, "h").withColumn("least", least).where("cost = least").select("h", "i", "p")


def _texts(docs: DataFrame, pairs: DataFrame, text: str) -> DataFrame:
    """(t1, t2, s): the folded text of every pair, once."""
    wanted = pairs.select("t1", "t2").distinct()
    n = wanted.count()
    if n <= HASHES_SENT:
        wanted = F.broadcast(wanted)
    else:
        bitmap = docs.sparkSession.sparkContext.broadcast(bloom(wanted, "t1", n))

        @F.pandas_udf("boolean")
        def wanted_hash(t: pd.Series) -> pd.Series:
            m, bits = bitmap.value
            out = np.zeros(len(t), bool)
            out[_passes(t.to_numpy(np.int64), np.frombuffer(m, np.uint8), bits)] = True
            return pd.Series(out)

        docs = docs.where(wanted_hash("t1"))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["s"] = [x for lo, hi in _slices(pdf[text].tolist()) for x in fold_texts(pdf[text].iloc[lo:hi].tolist())]
            yield pdf[["t1", "t2", "s"]]

    one = docs.select("t1", "t2", text).join(wanted, ["t1", "t2"]).dropDuplicates(["t1", "t2"])
    return one.mapInPandas(fold, "t1 long, t2 long, s string")


def leaks(docs: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", run: int = RUN, share: float = EDITED_SHARE) -> DataFrame:
    """(doc_id, item_id, run_length, score, score_share) of every leak.

    Every pair whose texts share an unbroken run of ``run`` characters comes out
    with the length of its longest such run; so does every pair that shares a
    seed and whose alignment reaches ``share`` of the item's best possible
    score. The score is that of the best alignment around all shared seeds; the
    run is measured on their diagonals, in pairs that the score lets through. An
    item lighter than an n-gram is found where it stands whole. NULL and empty
    texts match nothing; repeated documents and items come out once per row.
    Columns other than id and text are ignored.
    """
    if run < WEIGHT + 2 * STRETCH - 2:
        raise ValueError("so short a run may hold no seed")
    doc_kind, item_kind = docs.schema[doc_id].dataType, items.schema[item_id].dataType
    corpus = docs.where(F.length(text) > 0).select(F.col(doc_id).alias("d"), F.col(text).alias("x"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit("2"), text).alias("t2"))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["s"] = fold_texts(pdf["s"].tolist())
            yield pdf[pdf["s"] != ""]

    own = items.where(F.length(text) > 0).select(F.col(item_id).alias("e"), F.col(text).alias("s"))
    own = settle(own.mapInPandas(fold, own.schema), "items")
    kinds = settle(own.select("s").distinct().withColumn("i", F.monotonically_increasing_id()), "item-kinds")
    grams = settle(item_grams(kinds), "item-grams")
    sizes = {r["size"]: r["n"] for r in grams.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}  # WEIGHT sizes at most
    if not sizes:
        return docs.sparkSession.createDataFrame([], f"{doc_id} {doc_kind.simpleString()}, {item_id} {item_kind.simpleString()}, run_length int, score int, score_share double")
    filters = {size: bloom(grams.where(F.col("size") == size), "h", n) for size, n in sizes.items()}
    places = settle(corpus_places(corpus, "d", "x", filters), "places")
    chosen = settle(seeds(grams, places), "seeds")
    hits = places.select("t1", "t2", F.explode(F.arrays_zip("hs", "at")).alias("z")).select("t1", "t2", F.col("z.hs").alias("h"), F.col("z.at").alias("at"))
    pairs = hits.join(chosen, "h").groupBy("t1", "t2", "i").agg(F.collect_set(F.col("at") - F.col("p")).alias("diagonals"))
    pairs = settle(pairs, "pairs")
    reach = F.least(F.floor(F.length("item") * F.lit(MATCH / -GAP)), F.lit(REACH)).cast("int")
    begin = F.greatest(F.array_min("diagonals") - reach, F.lit(0))
    end = F.array_max("diagonals") + F.length("item") + reach
    met = pairs.join(_texts(corpus, pairs, "x"), ["t1", "t2"]).join(kinds.withColumnRenamed("s", "item"), "i").select(
        "t1", "t2", "i", "item", F.substring("s", begin + 1, end - begin).alias("window"), F.transform("diagonals", lambda d: d - begin).alias("diagonals")
    )

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            met = [(a, b, [int(d) for d in ds]) for a, b, ds in zip(pdf["item"], pdf["window"], pdf["diagonals"])]
            best = [MATCH * len(a) for a, _, _ in met]
            scores = seeded_scores(met, [min(MATCH * run, -int(-share * m // 1)) for m in best])
            runs = [longest_run(_codes(a), _codes(b), ds) if x else 0 for (a, b, ds), x in zip(met, scores)]
            out = pdf[["t1", "t2", "i"]].assign(run_length=runs, score=scores, score_share=[round(x / m, 4) for x, m in zip(scores, best)])
            yield out[(out["run_length"] >= run) | (out["score_share"] >= share)]

    scored = met.mapInPandas(score, "t1 long, t2 long, i long, run_length int, score int, score_share double")
    rows = scored.join(places.select("d", "t1", "t2"), ["t1", "t2"]).join(own.join(kinds, "s").select("e", "i"), "i")
    return rows.select(F.col("d").alias(doc_id), F.col("e").alias(item_id), "run_length", "score", "score_share")
