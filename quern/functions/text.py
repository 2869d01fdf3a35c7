"""Name normalisation as Column expressions.

All of it stays on the JVM except the compatibility form of strings outside
plain ASCII and unified ideographs, which takes one Arrow UDF.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Keywords of brackets in names.
CATEGORY_WORDS = ("合作", "专项", "走读", "边防", "预科", "民族班", "定向", "公费", "航海")
ASIDE_WORDS = ("身高", "体重", "色盲", "色弱", "视力", "体检", "标准", "合格", "语种", "单科", "年龄", "特殊类型招生控制线", "不低于")
OUT_OF_SCOPE_WORDS = ("专科", "军士生", "定向培养军士")
# Categories that may be written inside a major's name, in the
# order in which they are looked for.
CATEGORY_MARKERS = ("省属公费师范生", "省属公费医学生", "省属公费农科生", "国家公费师范生", "地方专项计划", "高校专项计划", "综合评价招生", "中外合作办学")
# Patterns of brackets and of what stands in them.
BRACKET = r"\(([^()]*)\)"
GENDER = r"^[男女]$|^[男女][,，、]|[,，、][男女]$|[,，、][男女][,，、]|招[男女]生"
FACING = r"面向[^,，;；()]+就业"

DEFAULT_CATEGORY = "普通计划"
FAMILY = "类"
SPACES = r"(?U)[\s\x1c-\x1f]+"
_SIMPLE = r"^[\x21-\x7E一-鿿]*$"


@F.pandas_udf(StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode NFKC; NULL stays NULL."""
    return s.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def fold(col: Column) -> Column:
    """NFKC without any white space; NULL becomes ''."""
    s = F.coalesce(col.cast("string"), F.lit(""))
    rest = nfkc(F.when(~s.rlike(_SIMPLE), s))
    return F.regexp_replace(F.coalesce(rest, s), SPACES, "")


def fold_width(col: Column) -> Column:
    """Common full-width signs and blanks only; expressible in plain SQL."""
    s = F.translate(F.coalesce(col.cast("string"), F.lit("")), "（）：，；", "():,;")
    return F.regexp_replace(s, WIDTH_BLANKS, "")


WIDTH_BLANKS = r"[ \t\n\r\x{3000}\x{00a0}\x{2002}\x{2007}\x{2009}\x{202f}]"


def has_any(col: Column, words: Sequence[str]) -> Column:
    return col.rlike("|".join(re.escape(w) for w in words))


def out_of_scope(*cols: Column) -> Column:
    """Any of the values holds a keyword of rows left out; NULL-safe."""
    return has_any(F.concat_ws("\x01", *cols), OUT_OF_SCOPE_WORDS)


def is_category(content: Column) -> Column:
    return has_any(content, CATEGORY_WORDS)


def is_gender(content: Column) -> Column:
    return content.rlike(GENDER) & content.rlike("[男女]")


def is_aside(content: Column) -> Column:
    """A requirement; a bracket of gender alone never holds such a word."""
    return has_any(content, ASIDE_WORDS)


def split_school(name: Column) -> tuple[Column, Column]:
    """(base, category) of a folded name: only a bracket at the end counts, and
    it is split off if it tells a category, or dropped if it is empty."""
    end = r"\(([^()]*)\)$"
    there, content = name.rlike(end), F.regexp_extract(name, end, 1)
    named = there & is_category(content)
    base = F.when(named | (there & (content == "")), F.regexp_replace(name, end, "")).otherwise(name)
    return base, F.when(named, content).otherwise(F.lit(""))


def strip_asides(name: Column) -> Column:
    """A folded name without brackets of requirements; of such a bracket only
    the gender and the place of work it names are kept."""
    pieces = F.regexp_extract_all(name, F.lit(r"\([^()]*\)|[^()]+|[()]"), 0)

    def one(p: Column) -> Column:
        inner = F.substring(p, F.lit(2), F.length(p) - 2)
        facing = F.regexp_extract(inner, FACING, 0)
        gender = F.when(inner.contains("男"), F.lit("男")).otherwise(F.lit("女"))
        kept = F.concat(F.lit("("), gender, F.when(facing != "", F.concat(F.lit(","), facing)).otherwise(F.lit("")), F.lit(")"))
        aside = F.when(inner.rlike(GENDER), kept).otherwise(F.lit(""))
        return F.when(p.rlike(r"^\([^()]*\)$") & is_aside(inner), aside).otherwise(p)

    return F.array_join(F.transform(pieces, one), "")


def core_name(name: Column) -> Column:
    """A folded name without any closed bracket, however deep: the innermost
    ones go as often as there are opening ones."""

    def bare(n: Column) -> Column:
        levels = F.length(n) - F.length(F.replace(n, F.lit("("), F.lit("")))
        out = F.aggregate(F.sequence(F.lit(0), levels), n, lambda a, _: F.regexp_replace(a, BRACKET, ""))
        return F.when(n.contains("("), out).otherwise(n)

    # bound once, as ``name`` may be a long expression
    return F.get(F.transform(F.array(name), bare), F.lit(0))


def brackets(name: Column) -> Column:
    """Array of (kind, value) of a folded name's brackets in their order; kind
    is 性别, 合作 or 其他, in this precedence."""

    def one(c: Column) -> Column:
        gender = is_gender(c)
        kind = F.when(gender, F.lit("性别")).when(c.contains("合作"), F.lit("合作")).otherwise(F.lit("其他"))
        value = F.when(gender, F.when(c.contains("男"), F.lit("男")).otherwise(F.lit("女"))).otherwise(c)
        return F.struct(kind.alias("kind"), value.alias("value"))

    return F.transform(F.regexp_extract_all(name, F.lit(BRACKET), 1), one)


def brackets_within(candidate: Column, other: Column) -> Column:
    """Whether every bracket value of ``candidate`` stands in ``other``; true
    where there is none."""
    return F.forall(brackets(candidate), lambda b: F.contains(other, b["value"]))


def bracket_brief(name: Column, width: int = 10) -> Column:
    """The first bracket's value, shortened."""
    first = F.get(brackets(name), F.lit(0))["value"]
    cut = F.concat(F.substring(first, 1, width), F.when(F.length(first) > width, F.lit("…")).otherwise(F.lit("")))
    return F.coalesce(cut, F.lit("无差异化括号"))


def category_in_major(major: Column) -> Column:
    """The first marker of a category a folded major holds, or ''."""
    found = [F.when(major.contains(m), F.lit(m)) for m in CATEGORY_MARKERS]
    return F.coalesce(*found, F.lit(""))


def fold_category(cat: Column) -> Column:
    """The default category is no category."""
    c = F.coalesce(cat, F.lit(""))
    return F.when(c == DEFAULT_CATEGORY, F.lit("")).otherwise(c)


def family_keys(core: Column) -> Column:
    """The cores that ``core`` is compatible with: itself and, with or without
    the ending 类, its family. An empty core is compatible with nothing."""
    keys = F.array_distinct(F.array(core, F.concat(core, F.lit(FAMILY)), F.regexp_replace(core, FAMILY + "$", "")))
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.filter(keys, lambda k: k != ""))


def subject_atoms(subject: Column) -> Column:
    return F.filter(F.split(F.trim(subject), "和"), lambda x: x != "")


def subject_covers(new: Column, past: Column, variants: str = " \\| ") -> Column:
    """Whether one of the variants in ``past`` asks for all that ``new`` asks.

    Nothing asked (no part at all) is covered by anything; an empty past covers
    nothing else.
    ``variants`` is the pattern between variants: with its blanks by default,
    ``\\s*\\|\\s*`` to allow for blanks removed by folding."""
    n, p = F.coalesce(new, F.lit("")), F.coalesce(past, F.lit(""))
    wanted = subject_atoms(n)
    some = F.exists(F.split(p, variants), lambda v: F.size(F.array_except(wanted, subject_atoms(v))) == 0)
    return F.when(F.size(wanted) == 0, F.lit(True)).when(F.trim(p) == "", F.lit(False)).otherwise(some)


def subject_differs(a: Column, b: Column) -> Column:
    x, y = F.trim(F.coalesce(a, F.lit(""))), F.trim(F.coalesce(b, F.lit("")))
    return (x != "") & (y != "") & (x != y)


def blank_row(*cols: Column) -> Column:
    """Whether every cell is NULL or ''."""
    return F.forall(F.array(*[c.cast("string") for c in cols]), lambda x: F.coalesce(x, F.lit("")) == "")


def cut_reason(reason: Column, width: int = 30) -> Column:
    """A reason, trimmed and cut by code points."""
    return F.substring(F.trim(reason), 1, width)
