"""Several values packed in one field, one row per value.

Pure SQL expressions: the known names that hold a delimiter or a quote are
masked, the field is split on quote characters, and a fold over the pieces puts
the values together again in their order: pieces within quotes are literals, the
others are split on delimiters outside brackets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.session import at_most, salted_join

# Opening and closing quotes and delimiters of packed fields.
QUOTE_PAIRS = {'"': '"', "'": "'", "“": "”", "”": "”", "‘": "’", "’": "’", "「": "」", "『": "』"}
QUOTES = "\"'“”‘’「」『』"
DELIMITERS = "、,，;；|｜/／+＋&＆\\s　 "
DELIMITER_WORDS = ("和", "及", "与")

#: Names with delimiters are masked by literals up to this many; beyond it each
#: field is joined with the names that occur in it.
LITERAL_NAMES = 200

_MASK = chr(0xFDD0)  # no character; one of private use after it is a masked name
_NAMES = "".join(chr(c) for c in range(0xE000, 0xF8FF))
_ODD = "(),、，;；|/+&和及与 " + QUOTES

_DELIM = f"(?:[{DELIMITERS}]|{'|'.join(DELIMITER_WORDS)})(?![^(（]*[)）])"


def special(name: str) -> bool:
    """Whether a name holds what may be taken for a delimiter or a quote."""
    return any(c in name for c in _ODD)


def _written(name: Column) -> Column:
    """A name as it stands within straight quotes, its own quotes doubled."""
    return F.replace(name, F.lit('"'), F.lit('""'))


def _split(s: Column) -> Column:
    return F.split(s, _DELIM, -1)


def _append(values: Column, text: Column) -> Column:
    """The last value, still open, with more text."""
    return F.concat(F.slice(values, F.lit(1), F.size(values) - 1), F.array(F.concat(F.element_at(values, -1), text)))


def _continue(values: Column, parts: Column) -> Column:
    """The first part goes on with the open value, the others begin new ones."""
    return F.concat(_append(values, F.element_at(parts, 1)), F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))))


def _folded(s: Column) -> Column:
    """Values of a field with quotes: a quote opens where a value begins, is
    closed by its own kind, and stands for itself doubled within a literal or
    inside a bare value."""
    pieces, quotes = F.split(s, f"[{QUOTES}]", -1), F.regexp_extract_all(s, F.lit(f"[{QUOTES}]"), 0)
    closer = F.create_map(*[F.lit(x) for kv in QUOTE_PAIRS.items() for x in kv])
    steps = F.zip_with(quotes, F.slice(pieces, F.lit(2), F.greatest(F.size(pieces) - 1, F.lit(0))), lambda q, p: F.struct(q.alias("q"), p.alias("p")))
    state = lambda v, o, c: F.struct(v.alias("v"), o.alias("open"), c.alias("closed"))
    none = F.lit("")

    def step(acc: Column, x: Column) -> Column:
        q, p, v = x["q"], x["p"], acc["v"]
        begins = F.trim(F.element_at(v, -1)) == ""
        return (
            F.when((acc["open"] != "") & (q == acc["open"]), state(_continue(v, _split(p)), none, F.when(p == "", q).otherwise(none)))
            .when(acc["open"] != "", state(_append(v, F.concat(q, p)), acc["open"], none))
            .when(acc["closed"] == q, state(_append(v, F.concat(q, p)), q, none))
            .when(begins & F.map_contains_key(closer, q), state(_append(v, p), F.try_element_at(closer, q), none))
            .otherwise(state(_continue(v, _split(F.concat(q, p))), none, none))
        )

    start = state(_continue(F.array(none), _split(F.element_at(pieces, 1))), none, none)
    return F.aggregate(steps, start, step, lambda acc: acc["v"])


def packed_values(col: Column, names: Sequence[str] | Column) -> Column:
    """Array of the values in ``col``, in the order written.

    ``names`` are the values with delimiters or quotes that a field may hold, as
    literals or as an array column: they are kept whole, quoted or not. Empty
    places, quoted or not, are dropped, repeats kept. NULL and blank fields give
    an empty array. An unclosed quote runs to the end of the field; a quote
    inside a bare value (O'Brien) belongs to it.
    """
    s = F.coalesce(col, F.lit(""))
    if isinstance(names, Column):
        marks = F.transform(names, lambda n, i: F.struct(n.alias("n"), F.concat(F.lit(_MASK), F.substring(F.lit(_NAMES), i + 1, F.lit(1))).alias("m")))
        masked = F.aggregate(marks, s, lambda acc, x: F.replace(F.replace(acc, _written(x["n"]), x["m"]), x["n"], x["m"]))
        unmask = lambda v: F.aggregate(marks, v, lambda acc, x: F.replace(acc, x["m"], x["n"]))
    else:
        odd = sorted((n for n in names if special(n)), key=lambda n: (-len(n), n))
        marks = [(n, F.lit(_MASK + _NAMES[i])) for i, n in enumerate(odd)]
        masked = s
        for n, m in marks:
            if '"' in n:
                masked = F.replace(masked, F.lit(n.replace('"', '""')), m)
            masked = F.replace(masked, F.lit(n), m)

        def unmask(v: Column) -> Column:
            for n, m in marks:
                v = F.replace(v, m, F.lit(n))
            return v

    values = F.when(masked.rlike(f"[{QUOTES}]"), _folded(masked)).otherwise(_split(masked))
    trimmed = F.transform(values, lambda v: F.trim(v))
    return F.transform(F.filter(trimmed, lambda v: v != ""), lambda v: F.when(v.contains(_MASK), unmask(v)).otherwise(v))


def _occurring(df: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """``df`` with ``_names``: the names that occur in the field, long ones
    first. Pieces of every distinct field with the length of a name meet the
    names in an equi-join."""
    forms = names.select(F.col("name"), F.explode(F.array_distinct(F.array(F.col("name"), _written(F.col("name"))))).alias("form"))
    lengths = forms.agg(F.array_sort(F.collect_set(F.length("form"))).alias("n")).first()["n"] or []
    fields = df.select(F.col(column).alias("_s")).where(F.length(column) > 0).distinct()
    starts = F.sequence(F.lit(1), F.length("_s"))
    pieces = F.flatten(F.transform(starts, lambda i: F.transform(F.array(*[F.lit(int(n)) for n in lengths]), lambda n: F.substring("_s", i, n))))
    met = fields.select("_s", F.explode(F.array_distinct(pieces)).alias("form")).join(forms, "form").select("_s", "name").distinct()
    longest = F.transform(F.array_sort(F.collect_list(F.struct((-F.length("name")).alias("l"), "name"))), lambda x: x["name"])
    found = met.groupBy("_s").agg(longest.alias("_names"))
    joined = salted_join(df.withColumn("_s", F.col(column)), found, ["_s"], "left", column)
    return joined.withColumn("_names", F.coalesce("_names", F.array().cast("array<string>"))).drop("_s")


def unpack(df: DataFrame, column: str, names: DataFrame | Sequence[str], *, position: str = "val_no", value: str = "subject_name", least: int = 1, limit: int = LITERAL_NAMES) -> DataFrame:
    """One row per value of ``column`` with its position, counted from 1.

    ``names`` lists the values a field may hold (or is a table whose first
    column does). All columns of ``df`` are kept, but for those that begin with
    ``_`` and for ``position`` and ``value``, which are the result's own; rows
    with fewer than ``least`` values give no row. Up to ``limit`` names with
    delimiters nothing is shuffled; values of one field stay in one task.
    """
    if isinstance(names, DataFrame):
        odd = names.select(F.col(names.columns[0]).alias("name")).where(F.col("name").rlike("[" + _ODD.replace("[", "\\[") + "]")).distinct()
        few = at_most(odd, limit)
        names = odd if few is None else [r["name"] for r in few]
    elif len(known := [n for n in names if special(n)]) > limit:
        names = df.sparkSession.createDataFrame([(n,) for n in known], "name string").distinct()
    kept = [c for c in df.columns if c not in (position, value) and not c.startswith("_")]
    # the field may have one of the result's names
    base = df.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{column}`").alias("_field"))
    if isinstance(names, DataFrame):
        base, names = _occurring(base, "_field", names), F.col("_names")
    out = base.select(*[F.col(f"`{c}`") for c in kept], packed_values(F.col("_field"), names).alias("_values")).where(F.size("_values") >= least)
    return out.select(*[F.col(f"`{c}`") for c in kept], F.posexplode("_values").alias("_p", value)).withColumn(position, (F.col("_p") + 1).cast("int")).drop("_p")
