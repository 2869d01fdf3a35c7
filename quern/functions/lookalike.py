"""Code-point folding: one comparison form for text that looks the same.

``plain_char`` gives the plain spelling of a single character that is decided
by the character alone (width, blanks, invisible characters, compatibility
ideographs, radicals, hyphens). Letters of other scripts are only folded in the
comparison key (``key``), since a word wholly in another script is plain.

``key`` stays on the JVM: a single ``translate`` with a rule-built table. Only
strings with combining marks or characters of several letters take an Arrow UDF.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Letters of other scripts that look like a Latin letter, as in
# the confusables of Unicode Technical Standard 39.
LATIN_LOOKALIKES = {
    # Greek
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O",
    "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "Ϲ": "C", "Ϳ": "J",
    "α": "a", "γ": "y", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
    "ϲ": "c", "ϳ": "j",
    # Cyrillic
    "А": "A", "В": "B", "Е": "E", "Ѕ": "S", "І": "I", "Ј": "J", "К": "K", "М": "M", "Н": "H", "О": "O",
    "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "Ү": "Y", "Ѵ": "V", "Ӏ": "I", "Ԍ": "G", "Ԛ": "Q", "Ԝ": "W",
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "і": "i", "ј": "j",
    "һ": "h", "ѵ": "v", "ӏ": "l", "ԁ": "d", "ԛ": "q", "ԝ": "w", "ү": "y", "к": "k",
    # Armenian
    "Լ": "L", "Ս": "U", "Տ": "S", "Օ": "O", "ա": "w", "զ": "q", "հ": "h", "յ": "j", "ո": "n", "ս": "u",
    "ց": "g", "օ": "o",
    # Coptic
    "Ⲁ": "A", "Ⲃ": "B", "Ⲉ": "E", "Ⲏ": "H", "Ⲓ": "I", "Ⲕ": "K", "Ⲙ": "M", "Ⲛ": "N", "Ⲟ": "O", "ⲟ": "o", "Ⲣ": "P", "ⲣ": "p",
    "Ⲥ": "C", "ⲥ": "c", "Ⲧ": "T", "Ⲩ": "Y", "Ⲭ": "X",
    # Cherokee
    "Ꭰ": "D", "Ꭱ": "R", "Ꭲ": "T", "Ꭵ": "i", "Ꭺ": "A", "Ꭻ": "J", "Ꭼ": "E", "Ꮃ": "W", "Ꮇ": "M", "Ꮋ": "H", "Ꮍ": "Y", "Ꮐ": "G",
    "Ꮓ": "Z", "Ꮩ": "V", "Ꮪ": "S", "Ꮮ": "L", "Ꮯ": "C", "Ꮲ": "P", "Ꮶ": "K", "Ᏼ": "B",
    # Lisu
    "ꓐ": "B", "ꓑ": "P", "ꓓ": "D", "ꓔ": "T", "ꓖ": "G", "ꓗ": "K", "ꓙ": "J", "ꓚ": "C", "ꓜ": "Z", "ꓝ": "F", "ꓟ": "M", "ꓠ": "N",
    "ꓡ": "L", "ꓢ": "S", "ꓣ": "R", "ꓦ": "V", "ꓧ": "H", "ꓪ": "W", "ꓫ": "X", "ꓬ": "Y", "ꓮ": "A", "ꓰ": "E", "ꓲ": "I", "ꓳ": "O",
    "ꓴ": "U",
    # Latin letters from phonetic blocks
    "ɑ": "a", "ɡ": "g", "ɩ": "i", "ʏ": "y", "ı": "i",
}

# Katakana that look like an ideograph.
HAN_LOOKALIKES = {
    "エ": "工", "カ": "力", "ロ": "口", "ニ": "二", "ハ": "八", "タ": "夕", "ト": "卜", "チ": "千", "ヒ": "匕", "ム": "厶",
    "ミ": "三", "オ": "才", "ー": "一",
}

# Radical forms without a compatibility decomposition.
RADICALS = {
    "⺁": "厂", "⺄": "乙", "⺇": "几", "⺈": "刀", "⺊": "卜", "⺌": "小", "⺎": "兀", "⺒": "巳", "⺓": "幺", "⺗": "心",
    "⺛": "旡", "⺜": "日", "⺝": "月", "⺟": "母", "⺠": "民", "⺢": "水", "⺥": "爪", "⺧": "牛", "⺩": "王", "⺫": "目",
    "⺬": "示", "⺮": "竹", "⺯": "糸", "⺳": "网", "⺶": "羊", "⺻": "聿", "⺼": "肉", "⺽": "臼", "⻁": "虎", "⻄": "西",
    "⻅": "见", "⻆": "角", "⻉": "贝", "⻋": "车", "⻌": "辶", "⻑": "長", "⻓": "长", "⻔": "门", "⻗": "雨", "⻘": "青",
    "⻙": "韦", "⻚": "页", "⻛": "风", "⻜": "飞", "⻝": "食", "⻢": "马", "⻣": "骨", "⻤": "鬼", "⻥": "鱼", "⻦": "鸟",
    "⻧": "卤", "⻨": "麦", "⻩": "黄", "⻬": "齐", "⻮": "齿", "⻰": "龙", "⻳": "龟",
}

# Signs that look like the hyphen-minus.
HYPHENS = "‐‑‒–−⁃˗﹘﹣－"

# Characters that are their own key, by themselves.
_SIMPLE = r"^[\x21-\x7E一-鿿、]*$"

SCRIPTS = (("L", "LATIN"), ("G", "GREEK"), ("C", "CYRILLIC"), ("A", "ARMENIAN"), ("O", "COPTIC"), ("H", "CHEROKEE"), ("I", "LISU"))


def invisible(ch: str) -> bool:
    """Characters without a mark of their own: format and control characters,
    variation selectors, fillers."""
    cp = ord(ch)
    if ch in "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85":
        return False
    return unicodedata.category(ch) in ("Cf", "Cc") or 0xFE00 <= cp <= 0xFE0F or 0xE0100 <= cp <= 0xE01EF or cp in (0x034F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, 0x180B, 0x180C, 0x180D)


def plain_char(ch: str) -> str:
    """The plain spelling of one character, looked at alone."""
    if ch < "\x7f" and ch >= " ":
        return ch
    if invisible(ch):
        return ""
    if ch.isspace():
        return " "
    if ch in HYPHENS:
        return "-"
    if ch in RADICALS:
        return RADICALS[ch]
    if ch == "Ϲ" or ch == "ϲ":
        return ch  # their compatibility form is a sigma, which looks different
    deco = unicodedata.decomposition(ch)
    if not deco:
        return ch
    if deco[0] != "<":  # canonical: composed letters stay, singletons fold
        nfc = unicodedata.normalize("NFC", ch)
        return nfc if nfc != ch and len(nfc) == 1 else ch
    tag = deco[1 : deco.index(">")]
    folded = unicodedata.normalize("NFKC", ch)
    if tag in ("wide", "narrow", "small", "font", "noBreak"):
        return folded
    if tag == "compat" and folded.isalnum():
        return folded
    return ch


@lru_cache(maxsize=1)
def plain_table() -> dict[str, str]:
    """Every character whose plain spelling is another one (rule-built)."""
    blocks = ((0x00, 0x3400), (0xA000, 0xAC00), (0xF900, 0x10000), (0x1D400, 0x1D800), (0x2F800, 0x2FA20), (0xE0000, 0xE0200))
    out = {}
    for lo, hi in blocks:
        for cp in range(lo, hi):
            ch = chr(cp)
            if unicodedata.category(ch) in ("Cn", "Cs", "Co") and not invisible(ch):
                continue
            if (p := plain_char(ch)) != ch:
                out[ch] = p
    return out


@lru_cache(maxsize=1)
def key_table() -> dict[str, str]:
    """``plain_table`` closed under the look-alike letters of other scripts."""
    alike = LATIN_LOOKALIKES | HAN_LOOKALIKES
    out = dict(alike)
    for ch, p in plain_table().items():
        out[ch] = "".join(alike.get(c, c) for c in p)
    return out


@lru_cache(maxsize=1)
def _key_ord() -> dict[int, str]:
    return {ord(c): p for c, p in key_table().items()}


def key_text(s: str | None) -> str | None:
    """Python form of ``key`` (used by the slow path and by tests)."""
    if s is None:
        return None
    s = unicodedata.normalize("NFC", s.translate(_key_ord()))
    return " ".join(s.translate(_key_ord()).split(" ")).strip(" ")


@lru_cache(maxsize=1)
def _jvm_tables() -> tuple[str, str, str]:
    """(from, to) for ``translate`` and the class of characters it can't do."""
    one, gone, many = {}, [], []
    for ch, p in sorted(key_table().items()):
        if len(p) == 1:
            one[ch] = p
        elif not p:
            gone.append(ch)
        else:
            many.append(ch)
    hard = "[\\p{M}" + "".join(many) + "]"
    return "".join(one) + "".join(gone), "".join(one.values()), hard


def key(col: Column) -> Column:
    """Comparison key: equal for two strings that look the same.

    NULL stays NULL; outer blanks are cut; '' stays ''. Not meant for display.
    """
    src, dst, hard = _jvm_tables()
    odd = ~col.rlike(_SIMPLE)  # most strings are plain and need no table
    mapped = F.translate(F.when(odd, col), src, dst)
    # variation selectors are marks too, but translate has already removed them
    rest = _key_slow(F.when(mapped.rlike(hard), col))
    return F.coalesce(F.trim(rest), F.trim(mapped), col)


@F.pandas_udf(StringType())
def _key_slow(s: pd.Series) -> pd.Series:
    return s.map(key_text, na_action="ignore")


def key_sql(column: str) -> str:
    """``key`` as DuckDB SQL, for checks against another engine."""
    src, dst, _ = _jvm_tables()
    many = [(c, p) for c, p in sorted(key_table().items()) if len(p) > 1]
    q = lambda x: "'" + x.replace("'", "''") + "'"
    inner = column
    if many:
        steps = "list_value(" + ", ".join(f"struct_pack(a := {q(c)}, b := {q(p)})" for c, p in many) + ")"
        inner = f"CASE WHEN regexp_matches({column}, '[{''.join(c for c, _ in many)}]') THEN list_reduce(list_prepend({column}, list_transform({steps}, lambda x: x.a || chr(1) || x.b)), lambda acc, x: replace(acc, split_part(x, chr(1), 1), split_part(x, chr(1), 2))) ELSE {column} END"
    once = f"translate({inner}, {q(src)}, {q(dst)})"
    full = f"trim(translate(nfc_normalize({once}), {q(src)}, {q(dst)}))"
    return f"CASE WHEN regexp_matches({column}, '[^\u4e00-\u9fff -~、]') THEN {full} ELSE trim({column}) END"
