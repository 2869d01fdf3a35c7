"""One plain spelling for text that looks the same (problem 1).

Classes of look-alike strings and code points are the transitive closure
(union-find) of the fixed and rule-built pairs; words of the corpus fall into
classes by the classes of their letters. Representatives go by frequency over
all rows, where more than one member of a class is plain by itself. Rewriting is
greedy, leftmost-longest, by a multi-pattern automaton over the variants that
occur.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.lookalike import HAN_LOOKALIKES, LATIN_LOOKALIKES, SCRIPTS, plain_table
from quern.llm.unionfind import UnionFind
from quern.session import at_most, settle

#: Variant words are broadcast up to this many; beyond it they are joined.
VARIANTS_LIMIT = 200_000

# Text without any of these characters, outer or double blanks is plain.
_PLAIN = r"^(?! )(?:[\x21-\x7E一-鿿㐀-䶿、]|(?<! ) (?! |$))*$"
_PY_WORD = re.compile(r"(?:[A-Za-zªºÀ-ɏɐ-ʯͰ-ϿЀ-ԯԱ-֏Ꭰ-ᏽḀ-῿Ⱡ-ⳮꓐ-ꓷ꜠-ꟿꭰ-ꮿ][̀-ͯ]*)+")
_KANA = re.compile(r"[ァ-ヺー-ヿ]+")


Pairs = Iterable[tuple[str, str]]


def look_alike_classes(pairs: Pairs = ()) -> UnionFind:
    """Transitive classes of everything that looks alike by its characters;
    ``pairs`` are further ones (strings of any length)."""
    uf = UnionFind()
    uf.union_all((ch, p) for ch, p in plain_table().items() if p.strip())
    uf.union_all(LATIN_LOOKALIKES.items())
    uf.union_all(HAN_LOOKALIKES.items())
    return uf.union_all(pairs)


def eligible(members: Iterable[str]) -> list[str]:
    """Members of a class that are plain by themselves and no letter of another
    script (these are a matter of the word they stand in)."""
    table = plain_table()
    return [m for m in members if not any(c in table or c in LATIN_LOOKALIKES or c in HAN_LOOKALIKES for c in m)]


def contested(uf: UnionFind) -> list[str]:
    """Plain members of classes that have several."""
    return sorted(m for members in uf.classes().values() if len(own := eligible(members)) > 1 for m in own)


def representatives(uf: UnionFind, counts: dict[str, int]) -> dict[str, str]:
    """For every variant its class's plain representative: the most frequent of
    the plain members; of equally frequent ones ASCII goes first, then the lower
    string."""
    table, out = plain_table(), {}
    for members in uf.classes().values():
        own = eligible(members)
        best = min(own, key=lambda m: (-counts.get(m, 0), not m.isascii(), m)) if own else None
        for m in members:
            if m in table:
                # a wide or compatibility form of another script's letter stays in that script
                p = table[m]
                out[m] = p if p in LATIN_LOOKALIKES or p in HAN_LOOKALIKES or best is None or len(p) > 1 and p in own and best == p else best
            elif m in own and m != best:
                out[m] = best
    return out | {ch: p for ch, p in table.items() if not p.strip()}


@lru_cache(maxsize=1)
def latin_letters() -> dict[str, str]:
    """For every letter of a class with a Latin letter, that letter."""
    out = {}
    for members in look_alike_classes().classes().values():
        latin = [m for m in members if len(m) == 1 and m.isascii() and m.isalpha()]
        out |= {m: latin[0] for m in members if latin and m in LATIN_LOOKALIKES}
    return out


def automaton(patterns: dict[str, str]) -> ahocorasick.Automaton | None:
    if not patterns:
        return None
    a = ahocorasick.Automaton()
    for old, new in patterns.items():
        a.add_word(old, (len(old), new))
    a.make_automaton()
    return a


def rewrite(a: ahocorasick.Automaton | None, s: str) -> str:
    """Greedy leftmost-longest replacement of every pattern of ``a`` in ``s``."""
    if a is None or not s:
        return s
    out, at = [], 0
    for end, (n, new) in a.iter_long(s):
        start = end - n + 1
        out.append(s[at:start])
        out.append(new)
        at = end + 1
    out.append(s[at:])
    return "".join(out)


def tidy(s: str) -> str:
    """Composed accents, single inner blanks, none at the ends."""
    return " ".join(x for x in unicodedata.normalize("NFC", s).split(" ") if x)


def han_words(s: str) -> str:
    """Katakana that look like an ideograph, in a word of ideographs.

    A katakana run stands as a word of its own, and is plain, where it has a
    character without such a look-alike or no ideograph beside it."""

    def one(m: re.Match) -> str:
        run = m.group()
        if not all(c in HAN_LOOKALIKES for c in run):
            return run
        beside = s[m.start() - 1 : m.start()] + s[m.end() : m.end() + 1]
        if any("㐀" <= c <= "鿿" for c in beside):
            return "".join(HAN_LOOKALIKES[c] for c in run)
        return run

    return _KANA.sub(one, s)


def script_of(ch: str) -> str:
    name = unicodedata.name(ch, "")
    return next((k for k, n in SCRIPTS if name.startswith(n)), "")


def one_script(word: str) -> str:
    """The script of all letters of ``word``, or '' where they are mixed."""
    found = {script_of(c) for c in word if not unicodedata.combining(c)}
    return found.pop() if len(found) == 1 else ""


def skeleton(word: str) -> str:
    """Class sequence of a word: each letter by the Latin letter of its class, if any."""
    letters = latin_letters()
    return unicodedata.normalize("NFC", "".join(letters.get(c, c) for c in unicodedata.normalize("NFD", word)))


def spelled_in(word: str, script: str) -> str:
    """``word`` with its look-alike letters taken from one script."""
    back = {}
    for c, p in latin_letters().items():
        if script_of(c) == script:
            back.setdefault(p, c)
    out = []
    for c in unicodedata.normalize("NFD", word):
        p = latin_letters().get(c, c)
        out.append(p if script == "L" else c if script_of(c) == script else back.get(p, c))
    return unicodedata.normalize("NFC", "".join(out))


def word_classes(words: Iterable[str]) -> dict[str, list[str]]:
    """Words that look alike: joined with their class sequences by union-find."""
    words = list(words)
    uf = UnionFind().union_all((w, skeleton(w)) for w in words)
    out: dict[str, list[str]] = {}
    for w in words:
        out.setdefault(uf.find(w), []).append(w)
    return out


def best_spelling(members: list[tuple[str, int]]) -> str:
    """Representative of a class of words: the most frequent spelling in one
    script; ties go to Latin, then to the lower string. Where every member is
    mixed, the script of the letters without a Latin look-alike decides."""
    single = [(w, n) for w, n in members if one_script(w)]
    if single:
        return min(single, key=lambda x: (-x[1], one_script(x[0]) != "L", x[0]))[0]
    word = min(members, key=lambda x: (-x[1], x[0]))[0]
    bound = {script_of(c) for c in word if c not in LATIN_LOOKALIKES and script_of(c) not in ("", "L")}
    return spelled_in(word, min(bound) if bound else "L")


def suspicious(col: Column) -> Column:
    """Whether a text can differ from its plain spelling by its characters."""
    return ~col.rlike(_PLAIN)


def _folded(chars: dict[str, str], rows: DataFrame, text: str, words: bool) -> DataFrame:
    """Adds ``_base`` (characters folded, blanks tidied, kana put right) and,
    if wanted, its words."""
    schema = T.StructType([*rows.schema.fields, T.StructField("_base", T.StringType())] + [T.StructField("_words", T.ArrayType(T.StringType()))] * words)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = automaton(chars)
        for pdf in batches:
            base = [han_words(tidy(rewrite(a, s))) for s in pdf[text]]
            pdf["_base"] = base
            if words:
                pdf["_words"] = [_PY_WORD.findall(s) for s in base]
            yield pdf

    return rows.mapInPandas(fold, schema)


def plain_spelling(rows: DataFrame, text: str, *, pairs: Pairs = (), variants_limit: int = VARIANTS_LIMIT) -> DataFrame:
    """Rows of ``rows`` whose ``text`` differs from its plain spelling, with
    that spelling in the column ``plain``.

    Columns of ``rows`` are kept, but for ``plain`` and names beginning with
    ``_``, which are the operator's own. NULL has no spelling and gives no row; '' is plain; a
    text of blanks and invisible characters is spelled ''. Repeated rows give
    repeated results. ``pairs`` are further strings that look alike. Frequencies
    are those of all rows.

    Rows are never joined on their text, so a text held by a third of them is
    no hot key: words are counted with map-side combining, and the variants
    (words that aren't their class's representative) go to the tasks as an
    automaton while there are at most ``variants_limit``; beyond that, words of
    the suspicious rows are joined with the variants instead.
    """
    rows = rows.select(*[F.col(f"`{c}`") for c in rows.columns if c != "plain" and not c.startswith("_")]).where(F.col(text).isNotNull())
    uf = look_alike_classes(pairs)
    rivals = contested(uf)
    odd = suspicious(F.col(text))
    counts = {}
    if rivals:  # how often each rival occurs, over all rows
        times = [F.sum((F.length(text) - F.length(F.replace(F.col(text), F.lit(m), F.lit("")))) / len(m)).alias(f"n{i}") for i, m in enumerate(rivals)]
        counts = {m: int(n or 0) for m, n in zip(rivals, rows.agg(*times).first())}
        for m in rivals:
            odd = odd | F.col(text).contains(m)
    strange = rows.where(odd)
    # the characters that occur at all: one row per code point at most
    seen = {r["c"] for r in strange.select(F.explode(F.array_distinct(F.split(F.col(text), ""))).alias("c")).distinct().collect()}
    chars = {c: p for c, p in representatives(uf, counts).items() if set(c) <= seen}
    fresh = settle(_folded(chars, strange, text, True), "plain")
    # word frequencies: plain rows hold ASCII words only and need no folding
    clean = rows.where(~odd & F.col(text).rlike("[A-Za-z]")).select(F.explode(F.regexp_extract_all(F.col(text), F.lit("[A-Za-z]+"), 0)).alias("w"))
    words = clean.unionByName(fresh.select(F.explode("_words").alias("w"))).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    variants = _variants(words)
    known = at_most(variants, variants_limit)
    if known is not None:
        out = _rewritten(fresh, {r["w"]: r["best"] for r in known}, text, None)
    else:
        # one array of (word, representative) per row; words of a text are
        # bounded by its length, the join key is the word
        tagged = fresh.withColumn("_id", F.concat_ws(":", F.spark_partition_id(), F.monotonically_increasing_id()))
        tagged = settle(tagged, "plain-rows")
        pairs = tagged.select("_id", F.explode(F.array_distinct("_words")).alias("w")).join(variants, "w").groupBy("_id").agg(F.collect_list(F.struct("w", "best")).alias("_pairs"))
        out = _rewritten(tagged.join(pairs, "_id", "left").drop("_id"), {}, text, "_pairs")
    return out


def _variants(words: DataFrame) -> DataFrame:
    """(w, best) for words that aren't the representative of their class. Words
    of ASCII letters are plain, however rare."""
    alike = "".join(latin_letters())
    # a class with a word of ASCII letters only and no other member is settled
    skel = F.when(F.col("w").rlike("^[A-Za-z]+$"), F.col("w")).otherwise(_skeleton(F.when(~F.col("w").rlike("^[A-Za-z]+$"), F.col("w"))))
    tagged = words.withColumn("k", skel)
    marked = tagged.withColumn("odd", F.col("w").rlike(f"[{alike}]"))
    odd_keys = marked.where("odd").select("k").distinct()
    classes = marked.join(odd_keys, "k", "left_semi")

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        # spellings of one word: at most the product of its letters' classes
        times = dict(zip(pdf["w"], pdf["n"]))
        found = []
        for members in word_classes(times).values():
            best = best_spelling([(w, times[w]) for w in members])
            found += [(w, best) for w in members if w != best and not w.isascii()]
        return pd.DataFrame(found, columns=["w", "best"])

    return classes.groupBy("k").applyInPandas(choose, "w string, best string")


@F.pandas_udf(T.StringType())
def _skeleton(s: pd.Series) -> pd.Series:
    return s.map(skeleton, na_action="ignore")


def _rewritten(rows: DataFrame, known: dict[str, str], text: str, pairs: str | None) -> DataFrame:
    keep = [f for f in rows.schema.fields if not f.name.startswith("_")]
    schema = T.StructType([*keep, T.StructField("plain", T.StringType())])

    def apply(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            own = dict(known)
            if pairs:
                for ps in pdf[pairs]:
                    if ps is not None:
                        own.update((p["w"], p["best"]) for p in ps)
            odd = {w for ws in pdf["_words"] for w in ws}
            # every whole word of the batch is a pattern, so that no shorter
            # variant matches inside another word
            a = automaton({w: own.get(w, w) for w in odd}) if any(w in own for w in odd) else None
            pdf["plain"] = [rewrite(a, s) for s in pdf["_base"]]
            yield pdf[pdf["plain"] != pdf[text]][[f.name for f in schema.fields]]

    return rows.mapInPandas(apply, schema)
