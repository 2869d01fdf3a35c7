"""Filling fixed-capacity containers with token sequences (problem 6).

Texts are measured once, where they are read; only (id, length) is shuffled.
Lengths are packed in shards of bounded size by variable-capacity best-fit:
items go from long to short into the open bin that they leave least space in; an
item that fits in none opens a bin, of the size that promises the least cost a
token; at the end every bin is downsized to its contents.
"""

from __future__ import annotations

import base64
import os
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Place of the public vocabularies; a parameter, nothing is copied from there.
TOKENIZER_DIR = "/opt/tokenizers"
TOKENIZER_FILE = "byte_bpe_multi_50k.tiktoken"
#: Items per packing shard; the shard's few last bins are all that it wastes.
SHARD_ITEMS = 50_000


def load_tokenizer(folder: str = TOKENIZER_DIR, name: str = TOKENIZER_FILE):
    """A tiktoken encoding from a rank file and the pattern beside it."""
    import importlib.util

    import tiktoken

    with open(os.path.join(folder, name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    spec = importlib.util.spec_from_file_location("_public_tokenizers", os.path.join(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return tiktoken.Encoding(name, pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = TOKENIZER_FILE) -> DataFrame:
    """(doc_id, n_tokens) of every row; NULL and '' have no tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = load_tokenizer(folder, name)
        for pdf in batches:
            yield pd.DataFrame({doc_id: pdf[doc_id], "n_tokens": [len(enc.encode_ordinary(s)) if s else 0 for s in pdf[text]]})

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, text).mapInPandas(count, f"{doc_id} {kind}, n_tokens long")


def pack_lengths(lengths: Sequence[int], capacities: Sequence[int], cost: Callable[[int], float] = float) -> list[tuple[int, int, int]]:
    """(bin number, offset, capacity of the bin) per item; no item may exceed
    the largest capacity. ``cost`` is what a bin of a capacity costs.

    Items go from long to short, each into the open bin with the least space
    that holds it. Where there is none, every capacity that holds the item is
    tried: the items left are laid in greedily, longest first, and the capacity
    with the least cost a token opens (the largest of equal ones). In the end each bin gets
    the cheapest capacity that holds what is in it. Items of length 0 join the
    first bin.
    """
    caps = sorted(set(capacities))
    by_length: dict[int, list[int]] = {}
    for i, n in enumerate(lengths):
        by_length.setdefault(n, []).append(i)
    left = sorted(n for n in by_length if n > 0)  # distinct lengths with items left
    place = [(0, 0)] * len(lengths)
    used: list[int] = []  # tokens in each bin
    size: list[int] = []
    spaces: list[int] = []  # distinct spaces of open bins, and the bins that have them
    bins: dict[int, list[int]] = {}
    while left:
        n = left[-1]
        ids = by_length[n]
        while ids:
            at = bisect_left(spaces, n)
            if at < len(spaces):
                space = spaces[at]
                b = bins[space].pop()
                if not bins[space]:
                    del bins[space], spaces[at]
            else:
                space = min((c for c in caps if c >= n), key=lambda c: (cost(c) / (c - _promise(by_length, left, n, c)), -c))
                b = len(used)
                used.append(0)
                size.append(space)
            # as many of this length as the bin takes
            for _ in range(min(space // n, len(ids)) if space < 2 * n or space % n == 0 else 1):
                place[ids.pop()] = (b, used[b])
                used[b] += n
                space -= n
            if space:
                if space not in bins:
                    insort(spaces, space)
                bins.setdefault(space, []).append(b)
        left.pop()
    final = {}
    for b, u in enumerate(used):
        final[b] = min((c for c in caps if c >= u), key=lambda c: (cost(c), c))
    _break_up(lengths, place, final, caps, cost)
    empty = min(caps, key=lambda c: (cost(c), c))
    return [(b, o, final.get(b, empty)) for b, o in place]


def _break_up(lengths: Sequence[int], place: list[tuple[int, int]], final: dict[int, int], caps: list[int], cost: Callable[[int], float]) -> None:
    """Puts what is in a bin into smaller ones where these cost less together."""
    used: dict[int, int] = {}
    for (b, _), n in zip(place, lengths):
        used[b] = used.get(b, 0) + n
    loose = {b for b, u in used.items() if final.get(b, u) - u >= caps[0]}
    held: dict[int, list[int]] = {}
    for i, (b, _) in enumerate(place):
        if b in loose:
            held.setdefault(b, []).append(i)
    for b, ids in held.items():
        smaller = [c for c in caps if c < final[b]]
        if not smaller or max(lengths[i] for i in ids) > smaller[-1]:
            continue
        parts = pack_lengths([lengths[i] for i in ids], smaller, cost)
        sizes = {k: c for k, _, c in parts}
        if sum(map(cost, sizes.values())) < cost(final[b]):
            names = {k: b if j == 0 else len(final) + j - 1 for j, k in enumerate(sorted(sizes))}
            for i, (k, o, _) in zip(ids, parts):
                place[i] = (names[k], o)
            final.update({names[k]: c for k, c in sizes.items()})


def _promise(by_length: dict[int, list[int]], left: list[int], first: int, cap: int) -> int:
    """Space left in a bin of ``cap`` that begins with ``first`` and takes the
    longest item that fits, again and again."""
    room, at, taken = cap - first, len(left), 1
    while room > 0:
        at = bisect_right(left, room, 0, at)
        if not at:
            break
        n = left[at - 1]
        many = len(by_length[n]) - (taken if n == first else 0)
        room -= n * min(room // n, max(many, 0))
        at -= 1
    return room


def pack(sizes: DataFrame, capacities: Sequence[tuple[int, int]], *, doc_id: str = "doc_id", size: str = "n_tokens", shard_items: int = SHARD_ITEMS, cost: Callable[[int], float] = float) -> DataFrame:
    """One row per piece: (doc_id, piece_no, start_token, n_tokens, bin_id,
    container_id, capacity_tokens, bin_offset).

    ``capacities`` are (container_id, capacity_tokens), ``cost`` what a bin of a
    capacity costs (its size, unless told otherwise). A row longer than the
    largest capacity, and no other, is cut into pieces of that capacity and a
    rest; full pieces fill a bin of their own. Rows without tokens take no
    space: they stand in a bin with capacity for them like any other. Repeated
    ids are packed once per row. NULL sizes count as 0. Shards are cut by hash,
    so no hot group exists; a bin's id is its shard's number and its own.
    """
    caps = sorted({(int(c), int(i)) for i, c in capacities if c is not None and c > 0})
    if not caps:
        raise ValueError("no capacity to fill")
    largest = caps[-1][0]
    kind = sizes.schema[doc_id].dataType.simpleString()
    base = sizes.select(F.col(doc_id), F.coalesce(F.col(size), F.lit(0)).cast("long").alias("n_tokens"))
    n_pieces = F.greatest(F.ceil(F.col("n_tokens") / F.lit(largest)), F.lit(1))
    pieces = base.select(doc_id, "n_tokens", F.explode(F.sequence(F.lit(1), n_pieces.cast("int"))).alias("piece_no")).select(
        doc_id,
        "piece_no",
        ((F.col("piece_no") - 1) * F.lit(largest)).cast("long").alias("start_token"),
        F.least(F.lit(largest).cast("long"), F.col("n_tokens") - (F.col("piece_no") - 1) * largest).alias("n_tokens"),
    )
    # by pieces, not rows: one giant text may have more of them than a shard holds
    total = base.agg(F.sum(n_pieces)).first()[0] or 0
    shards = max(1, -(-total // shard_items))
    sharded = pieces.withColumn("shard", F.pmod(F.xxhash64(doc_id, "piece_no"), F.lit(shards)))
    container = {c: i for c, i in reversed(caps)}

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([doc_id, "piece_no"], kind="stable").reset_index(drop=True)
        place = pack_lengths(pdf["n_tokens"].tolist(), list(container), cost)
        pdf["bin_id"] = [int(key[0]) * 10_000_000 + b for b, _, _ in place]
        pdf["container_id"] = [container[c] for _, _, c in place]
        pdf["capacity_tokens"] = [c for _, _, c in place]
        pdf["bin_offset"] = [o for _, o, _ in place]
        return pdf.drop(columns="shard")

    schema = f"{doc_id} {kind}, piece_no int, start_token long, n_tokens long, bin_id long, container_id int, capacity_tokens int, bin_offset long"
    return sharded.groupBy("shard").applyInPandas(fill, schema)


def containers(df: DataFrame) -> list[tuple[int, int]]:
    """(container_id, capacity_tokens), one container for each capacity: there
    are no more of them than tokens in the largest."""
    rows = df.where("capacity_tokens > 0").groupBy("capacity_tokens").agg(F.min("container_id").alias("i")).collect()
    return [(r["i"], r["capacity_tokens"]) for r in rows]


def unpacked(packed: DataFrame, docs: DataFrame, *, by: Sequence[str] = (), doc_id: str = "doc_id", text: str = "text", folder: str = TOKENIZER_DIR, name: str = TOKENIZER_FILE) -> DataFrame:
    """(*by, doc_id, text): the texts put together again from the tokens of their
    pieces (ids are unique); NULL comes back as ''. ``by`` tells apart several
    packings of the same documents."""
    spans = packed.groupBy(*by, doc_id).agg(F.array_sort(F.collect_list(F.struct("piece_no", "start_token", "n_tokens"))).alias("_spans"))
    rows = spans.join(docs.select(doc_id, text), doc_id).select(*by, doc_id, text, "_spans")

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = load_tokenizer(folder, name)
        for pdf in batches:
            out = []
            for t, spans in zip(pdf[text], pdf["_spans"]):
                tokens = enc.encode_ordinary(t) if t else []
                out.append(b"".join(enc.decode_bytes(tokens[x["start_token"] : x["start_token"] + x["n_tokens"]]) for x in spans).decode("utf-8"))
            yield pdf.drop(columns="_spans").assign(**{text: out})

    return rows.mapInPandas(decode, rows.drop("_spans").schema)


def broken_rules(packed: DataFrame, capacities: Sequence[tuple[int, int]], *, doc_id: str = "doc_id") -> DataFrame:
    """One row (overfull, oversized, gaps, splits): how many bins hold more than
    their capacity, could have been smaller, or have a gap between their pieces,
    and how many texts are cut though they fit in the largest capacity."""
    caps = sorted(c for _, c in capacities)
    below = F.lit(-1)
    for a, b in zip(caps, caps[1:]):
        below = F.when(F.col("capacity_tokens") == b, F.lit(a)).otherwise(below)
    bins = packed.groupBy("bin_id", "capacity_tokens").agg(F.sum("n_tokens").alias("used"), F.max(F.col("bin_offset") + F.col("n_tokens")).alias("end"))
    texts = packed.groupBy(doc_id).agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("total"))
    one = lambda c: c.cast("int")
    marks = bins.select(one(F.col("used") > F.col("capacity_tokens")).alias("overfull"), one(F.col("used") <= below).alias("oversized"), one(F.col("used") != F.col("end")).alias("gaps"), F.lit(0).alias("splits"))
    cut = texts.select(F.lit(0).alias("overfull"), F.lit(0).alias("oversized"), F.lit(0).alias("gaps"), one((F.col("n") > 1) & (F.col("total") <= caps[-1])).alias("splits"))
    return marks.unionByName(cut).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("overfull", "oversized", "gaps", "splits")])
