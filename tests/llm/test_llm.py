"""The training-data operators against brute force, round trips and labels."""

from __future__ import annotations

import os
import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quern.llm import linkage, lookalikes, packing, queries, textstats
from quern.llm.unionfind import UnionFind
from tests.helpers import DATA, rows, sql_rows

here = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@here
@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, name):
    df = queries.QUERIES[name](spark, DATA)
    got, sql = rows(df), queries.oracle().get(name)
    if sql:
        names, want = sql_rows(sql)
        assert sorted(df.columns) == names and got == want
    assert sum(got.values()) > 0


# --- 1: look-alikes -----------------------------------------------------------


def test_union_find():
    uf = UnionFind().union_all([("a", "b"), ("c", "d"), ("b", "c"), ("Ⅱ", "II"), ("x", "x")])
    assert sorted(uf.classes().values()) == [["II", "Ⅱ"], ["a", "b", "c", "d"], ["x"]]


PLAIN = "fid long, text string, plain string, _words int"


def spell(spark, texts, **kw):
    df = spark.createDataFrame([(i, t, "q", 7) for i, t in enumerate(texts)], PLAIN)
    return {texts[r["fid"]]: r["plain"] for r in lookalikes.plain_spelling(df, "text", **kw).collect()}


CASES = {
    "化エ检测（ＩｏＴ　班）": "化工检测(IoT 班)", "动カエ程": "动力工程", "​a\xa0b ": "a b", "E\u0301cole": "\u00c9cole", "НОΡЕ方向": "HOPE方向", "Α3校区": "A3校区", "⺠⽤⻝": "民用食",
    "\uf90a融": "\u91d1融", "ACE‐ТОP": "ACE-TOP", "Ⅱ班": "II班", "Mир": "Мир", "  ": "", "﻿": "", "科\U000e0100学": "科学", "，": ",",
}
KEPT = ["化工", "(エコ方向)", "Мир", "Ωμέγα", "IoT 班", "HOPE", "HOPE方向", "A3校区", "A3", "ACE-TOP", "TOP", "II班", "École", "含甲、乙", "", None, "エコ"]


@pytest.mark.parametrize("limit", [100_000, 0])
def test_plain_spelling(spark, limit):
    got = spell(spark, [*CASES, *KEPT, "Мир", "HOPE"], variants_limit=limit)
    assert got == CASES


def test_plain_edges(spark):
    assert spell(spark, []) == {} and spell(spark, [None, "", "甲"]) == {}
    long = "工エ程" * 30_000
    assert spell(spark, [long, "x"])[long] == "工工程" * 30_000
    df = spark.createDataFrame([(i, "化エ" if i % 3 == 0 else "甲", "", 0) for i in range(300)], PLAIN)
    out = lookalikes.plain_spelling(df, "text")
    assert out.count() == 100 and out.columns == ["fid", "text", "plain"]


def test_other_scripts(spark):
    texts = ["ⲘΟꓠ班", "Ꭺ3校区", "ᏣᎳᎩ", "ꓧОꓑE", "HOPE", "MON", "A3"]
    assert spell(spark, texts) == {"ⲘΟꓠ班": "MON班", "Ꭺ3校区": "A3校区", "ꓧОꓑE": "HOPE"}


def test_frequency_of_all_rows(spark):
    """Of plain strings told to look alike the most frequent stands, classes are transitive."""
    texts = ["〇一", "零一", "零二", "零三零", "○一", "甲", "第〇○", "ab cd", "ab-cd", "ab-cd"]
    pairs = [("〇", "零"), ("○", "〇"), ("ab cd", "ab-cd")]
    assert spell(spark, texts, pairs=pairs) == {"〇一": "零一", "○一": "零一", "第〇○": "第零零", "ab cd": "ab-cd"}
    more = [*texts, *["〇"] * 9]
    assert spell(spark, more, pairs=pairs)["零三零"] == "〇三〇"
    # words: the more frequent of two spellings, each in one script
    assert spell(spark, ["Миp", "ТОР", "ТОР", "ТОР", "TOP", "ТOР", "班TOP　"]) == {"Миp": "Мир", "ТOР": "ТОР", "班TOP　": "班TOP"}
    assert spell(spark, ["ТОР", "TOP", "TOP班"]) == {"ТОР": "TOP"}


def test_word_classes():
    got = lookalikes.word_classes(["TOP", "ТОР", "ТOР", "Мир", "Mиp", "x"])
    assert sorted(map(sorted, got.values())) == [["Mиp", "Мир"], ["TOP", "ТOР", "ТОР"], ["x"]]


def test_spelling_ties():
    assert lookalikes.best_spelling([("АI", 5), ("AI", 1), ("АІ", 1)]) == "AI"
    assert lookalikes.best_spelling([("Мup", 3)]) == "Mup" and lookalikes.best_spelling([("Миp", 2)]) == "Мир"
    a = lookalikes.automaton({"ab": "X", "abc": "Y", "b": "Z"})
    assert lookalikes.rewrite(a, "abcabbz") == "YXZz" and lookalikes.rewrite(None, "q") == "q"


# --- 2: linkage ---------------------------------------------------------------

L = "src_row_idx int, hist_pos long, school string, school_cat string, major string, direction string, stem string"


def one_slip(a, b):
    if abs(len(a) - len(b)) == 1:
        s, t = sorted((a, b), key=len)
        return any(t[:i] + t[i + 1 :] == s for i in range(len(t)))
    return len(a) == len(b) and any(a[:i] + a[i + 1] + a[i] + a[i + 2 :] == b for i in range(len(a) - 1))


def offers(rnd, n, noisy):
    schools, cats = ["淮杉棠矿冶学院", "燕靖霖旅游大学", "虹屿瓯纺织学院", "老名字师范大学"], ["", "普通计划", "走读", "中外合作办学"]
    stems = [a + b + c for a in ("水利", "纺织", "矿产") for b in ("口岸", "安全") for c in ("工程", "管理", "科学与技术")]
    for i in range(n):
        s, c, m, d = rnd.choice(schools), rnd.choice(cats), rnd.choice(stems), rnd.choice(["", "", "低碳", "IoT"])
        major, school, cat = m, s, c
        if noisy:
            if s.startswith("老名字"):
                school = "旧名字师范学院"
            k = rnd.randrange(8)
            if k == 0:
                p = rnd.randrange(2, len(m) - 2)
                major = m[:p] + m[p + 1 :]
            elif k == 1:
                major = m[:2] + m[3] + m[2] + m[4:]
            elif k == 2:
                major = m + "类"
            elif k == 3:
                major = m.replace("科学与技术", "科技")
            elif k == 4:
                major = m.replace("工程", "⼯程").replace("口岸", "ロ岸")
            elif k == 5 and not s.startswith("老"):
                school = s[:3] + s[4:]
        if d:
            major += f"({d}{rnd.choice(['', '方向', '专业方向', '班'])})"
        if noisy and c in ("走读", "中外合作办学"):
            how = rnd.randrange(3)
            short = {"中外合作办学": "中外合作"}.get(c, c)
            cat, school, major = (short, school, major) if how == 0 else ("", f"{school}（{c}）", major) if how == 1 else (None, school, f"{major}({c})")
        if rnd.random() < 0.3:
            major += rnd.choice(["(含甲学、乙学)", "(要求:无色盲色弱)", "(东湖校区)"])
        yield i, s, c if c != "普通计划" else "", m, d, school, cat, major


@pytest.mark.parametrize("seed", [1, 2])
def test_link_brute_force(spark, seed):
    rnd = random.Random(seed)
    plan, past = list(offers(rnd, 150, False)), list(offers(rnd, 150, True))
    p = spark.createDataFrame([(i, s, c, m, "clash") for i, *_, s, c, m in plan], "src_row_idx int, school string, school_cat string, major string, meant string")
    h = spark.createDataFrame([(i, s, c, m, 1) for i, *_, s, c, m in past], "hist_pos long, school string, school_cat string, major string, w int")
    r = spark.createDataFrame([("老名字师范大学", "旧名字师范学院", True), ("老名字师范大学", "旧名字师范学院", True), ("淮杉棠矿冶学院", "燕靖霖旅游大学", False), ("x", None, None)], "new_school string, old_school string, is_rename boolean")
    got = linkage.link(p, h, r)
    assert got.where("confidence <= 0 OR confidence > 1").count() == 0
    got = {(x["src_row_idx"], x["hist_pos"]) for x in got.collect()}
    want = {(a[0], b[0]) for a in plan for b in past if a[1:4] == b[1:4] and (not a[4] or not b[4] or a[4] == b[4])}
    assert got == want and len(want) > 50


def test_link_edges(spark):
    ps, hs, rs = "src_row_idx int, school string, school_cat string, major string", "hist_pos long, school string, school_cat string, major string", "new_school string, old_school string, is_rename boolean"
    empty = lambda s: spark.createDataFrame([], s)
    p = spark.createDataFrame([(1, "甲大学", None, "数学"), (2, None, None, "数学"), (3, "甲大学", "", None), (4, "", "", ""), (5, "甲大学", "普通计划", "数学" * 3000), (1, "甲大学", None, "数学")], ps)
    h = spark.createDataFrame([(10, "甲大学", "普通计划", "数学"), (10, "甲大学", "普通计划", "数学"), (11, None, None, None), (12, "甲大学", "走读", "数学")], hs)
    assert linkage.link(empty(ps), h, empty(rs)).count() == 0 and linkage.link(p, empty(hs), empty(rs)).count() == 0
    assert Counter(tuple(r)[:2] for r in linkage.link(p, h, empty(rs)).collect()) == {(1, 10): 4}
    # one offer holds most rows on one side
    hot = spark.createDataFrame([(i, "甲大学", None, "数学") for i in range(500)], ps)
    assert linkage.link(hot, h, empty(rs)).count() == 1000


def test_rename_chains(spark):
    names = ["晓沅民航学院", "峰柳海洋大学", "盛嵩水利学校", "霖景医药专科", "雀谷电力大专"]
    p = [(1, names[4], None, "数学"), (2, "德汾师范学院", None, "化学")]
    h = [(10, names[0], None, "数学"), (11, "德汾师学院", None, "化学")]
    chain = list(zip(names[1:], names))
    assert linked(spark, p, h, [(new, old, True) for new, old in chain]) == {(1, 10), (2, 11)}
    ends = lambda pairs: {tuple(x) for x in linkage.rename_ends(spark.createDataFrame(pairs, "new string, old string")).collect()}
    assert ends(chain) == {(old, names[4]) for old in names[:4]}
    assert ends([("b", "a"), ("a", "b"), ("a", "d")]) == {("a", "a"), ("b", "a"), ("d", "a")}


PS, HS, RS = "src_row_idx int, school string, school_cat string, major string", "hist_pos long, school string, school_cat string, major string", "new_school string, old_school string, is_rename boolean"


def linked(spark, plan, past, renames=(), **kw):
    out = linkage.link(spark.createDataFrame(plan, PS), spark.createDataFrame(past, HS), spark.createDataFrame(list(renames), RS), **kw)
    return {tuple(r)[:2] for r in out.collect()}


def test_pruning_keeps_known_names_apart(spark):
    """Two names that both sides know are different, though one slip apart."""
    plan = [(1, "甲大学", None, "农业检测"), (2, "甲大学", None, "数学"), (3, "乙大学", None, "农业检测学"), (4, "丙大学", None, "物理")]
    past = [(10, "甲大学", None, "农业检测学"), (11, "乙大学", None, "农业检测"), (12, "丙大学", None, "物理"), (13, "丙丁大学", None, "化学"), (14, "甲大学", None, "数学")]
    assert linked(spark, plan, past) == {(2, 14), (4, 12)}
    assert linked(spark, plan, past, prune=0.0) == {(2, 14), (4, 12), (1, 10), (3, 11)}
    # a name that one side alone knows is a slip
    assert linked(spark, plan, [*past, (15, "甲大学", None, "农业检")]) == {(2, 14), (4, 12), (1, 15)}


def test_propagation_settles_doubtful_schools(spark):
    """A slip of two schools goes to the one that explains more of its offers."""
    majors = ["数学", "物理", "化学", "生物"]
    plan = [(i, "甲乙丙学院", None, m) for i, m in enumerate(majors)] + [(10, "甲乙丁学院", None, "数学"), (11, "甲乙丁学院", None, "历史")]
    past = [(100 + i, "甲乙学院", None, m) for i, m in enumerate(majors)]
    right = {(i, 100 + i) for i in range(4)}
    assert linked(spark, plan, past) == right
    assert linked(spark, plan, past, rounds=0) == right | {(10, 100)}
    with pytest.raises(RuntimeError):
        linked(spark, plan, past, rounds=1)
    # offers that both schools could explain go with the school's other offers
    more = [*plan, (12, "甲乙丁学院", None, "物理"), (13, "甲乙丁学院", None, "化学")]
    assert linked(spark, more, past) == right


def test_doubtful_majors(spark):
    """A slip of two majors goes to the one with the same direction, then to the one that has no equal partner."""
    plan = [(1, "甲大学", None, "物流设计(智慧方向)"), (2, "甲大学", None, "物业设计"), (3, "乙大学", None, "物流设计"), (4, "乙大学", None, "物业设计")]
    past = [(10, "甲大学", None, "物设计(智慧班)"), (11, "乙大学", None, "物设计"), (12, "乙大学", None, "物业设计"), (13, "丙大学", None, "物流设计")]
    assert linked(spark, plan, past) == {(1, 10), (3, 11), (4, 12)}


@pytest.mark.parametrize("limit", [linkage.LITERAL_WORDS, 0])
def test_words_in_brackets(spark, limit):
    """Categories and directions are told by the data, by a literal map or by a join."""
    plan = [(1, "甲大学", "中外合作办学", "数学(智慧方向)"), (2, "甲大学", None, "数学(东湖校区)"), (3, "甲大学(走读)", None, "数学((a)(b)(c(d(e(f)))))"), (4, "甲大学", "普通计划", "物理(含机械班、声学班)")]
    past = [(10, "甲大学", None, "数学(中外合作)(智慧)"), (11, "甲大学", "普通计划", "数学(身高170cm以上)"), (12, "甲大学", "走读", "数学"), (13, "甲大学", "中外合作", "数学(精细班)"), (14, "甲大学", None, "物理(含声学)")]
    assert linked(spark, plan, past, words_limit=limit) == {(1, 10), (2, 11), (3, 12), (4, 14)}
    words = [("中外合作",), ("中外合作办学",), ("普通计划",), ("走读",)]
    got = {(r["word"], r["means"]) for r in linkage.category_names(spark.createDataFrame(words, "word string")).collect()}
    assert got == {("中外合作", "中外合作办学"), ("中外合作办学", "中外合作办学"), ("普通计划", ""), ("走读", "走读")}


def test_memberships_hold_the_copies(spark):
    plan = spark.createDataFrame([(i, "甲大学", None, "数学") for i in range(300)], PS)
    past = spark.createDataFrame([(i, "甲大学", None, "数学") for i in range(200)], HS)
    links, p, h, _ = linkage.offer_links(plan, past, spark.createDataFrame([], RS))
    assert (links.count(), p.count(), h.count()) == (1, 300, 200)


def test_slip_pairs(spark):
    rnd = random.Random(5)
    names = sorted({"".join(rnd.choices("甲乙丙", k=rnd.randrange(2, 6))) for _ in range(80)})
    side = {n: rnd.choice([(True, False), (False, True)]) for n in names}
    df = spark.createDataFrame([(n, n, *side[n], False, 1) for n in names], "name string, form string, in_plan boolean, in_past boolean, told boolean, n long")
    got = {(r["name"], r["meant"]) for r in linkage.name_edges(df, prune=0.0).collect()}
    assert got == {(m, n) for m in names for n in names if m != n and one_slip(m, n) and side[m] != side[n]}


# --- 6: packing ---------------------------------------------------------------

CAPS = [(1, 64), (2, 256), (3, 1024)]


def packed(spark, sizes, caps=CAPS, **kw):
    df = spark.createDataFrame(sizes, "doc_id long, n_tokens long, bin_id int")
    return [r.asDict() for r in packing.pack(df, caps, **kw).collect()]


def check_pack(sizes, out, caps):
    largest = max(c for _, c in caps)
    by, bins = defaultdict(list), defaultdict(list)
    for r in out:
        by[r["doc_id"]].append(r)
        bins[r["bin_id"]].append(r)
    want = Counter()
    for i, n, _ in sizes:
        want[i] += n or 0
    assert {i: sum(r["n_tokens"] for r in rs) for i, rs in by.items()} == dict(want)
    for i, n, _ in sizes:
        if Counter(s[0] for s in sizes)[i] == 1:
            pieces = sorted(by[i], key=lambda r: r["piece_no"])
            assert len(pieces) == max(1, -(-(n or 0) // largest))
            assert [r["start_token"] for r in pieces] == [k * largest for k in range(len(pieces))]
    for rs in bins.values():
        cap = rs[0]["capacity_tokens"]
        used = sum(r["n_tokens"] for r in rs)
        assert used <= cap and all(c < used for _, c in caps if c < cap) and len({r["container_id"] for r in rs}) == 1
        spans = sorted((r["bin_offset"], r["bin_offset"] + r["n_tokens"]) for r in rs if r["n_tokens"])
        assert all(b[0] == a[1] for a, b in zip(spans, spans[1:])) and (not spans or spans[0][0] == 0)
    return sum(want.values()) / max(1, sum(rs[0]["capacity_tokens"] for rs in bins.values()))


def test_pack(spark):
    rnd = random.Random(1)
    sizes = [(i, int(rnd.lognormvariate(4, 1.3)), 0) for i in range(3000)]
    out = packed(spark, sizes, shard_items=1000)
    assert check_pack(sizes, out, CAPS) > 0.99
    assert sorted(map(str, out)) == sorted(map(str, packed(spark, sizes[::-1], shard_items=1000)))
    assert check_pack(sizes, packed(spark, sizes, [(3, 1024)]), [(3, 1024)]) > 0.97


def test_pack_edges(spark):
    assert packed(spark, []) == []
    sizes = [(1, 0, 0), (2, None, 0), (3, 5000, 0), (4, 64, 0), (4, 64, 0), (5, 1024, 0)]
    out = packed(spark, sizes)
    check_pack(sizes, out, CAPS)
    assert len(out) == 10
    with pytest.raises(ValueError):
        packed(spark, sizes, [])
    # shards are cut by pieces: a giant text spreads over many
    giant = packed(spark, [(1, 1024 * 300 + 5, 0)], shard_items=50)
    assert len(giant) == 301 and len({r["bin_id"] // 10_000_000 for r in giant}) > 3


def naive_best_fit(lengths, cap):
    spaces = []
    for n in sorted(lengths, reverse=True):
        fits = [s for s in spaces if s >= n]
        if fits:
            spaces[spaces.index(min(fits))] = min(fits) - n
        else:
            spaces.append(cap - n)
    return len(spaces)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 100), max_size=60), st.lists(st.integers(100, 400), min_size=1, max_size=3))
def test_pack_lengths(lengths, caps):
    place = packing.pack_lengths(lengths, caps)
    bins = defaultdict(list)
    for n, (b, o, c) in zip(lengths, place):
        bins[b].append((o, n, c))
    for items in bins.values():
        cap, used = items[0][2], sum(n for _, n, _ in items)
        assert len({c for *_, c in items}) == 1 and cap == min(c for c in caps if c >= used)
        spans = sorted((o, o + n) for o, n, _ in items if n)
        assert all(b[0] == a[1] for a, b in zip(spans, spans[1:])) and (not spans or spans[0][0] == 0)
    if len(set(caps)) == 1:  # one capacity: as best-fit of decreasing items
        assert len(bins) == naive_best_fit([n for n in lengths if n], caps[0]) or not any(lengths)


def test_pack_costs():
    # bins of 100 are dear, so two of 50 are taken; a bin that is left half empty is broken up
    assert sorted(packing.pack_lengths([50, 50], [50, 100], cost=lambda c: {50: 1, 100: 9}[c])) == [(0, 0, 50), (1, 0, 50)]
    assert {c for *_, c in packing.pack_lengths([90, 30, 30, 30, 10], [64, 200])} == {200}
    assert sorted(c for *_, c in packing.pack_lengths([40, 30, 30], [50, 60, 400])) == [50, 60, 60]


def test_broken_rules(spark):
    cols = "doc_id long, piece_no int, n_tokens long, bin_id long, capacity_tokens int, bin_offset long"
    rows = [(1, 1, 60, 1, 64, 0), (2, 1, 10, 1, 64, 60), (3, 1, 30, 2, 256, 0), (4, 1, 5, 3, 64, 4), (5, 1, 20, 4, 64, 0), (5, 2, 20, 4, 64, 20), (6, 1, 256, 5, 256, 0), (6, 2, 4, 6, 64, 0)]
    got = packing.broken_rules(spark.createDataFrame(rows, cols), CAPS[:2]).first()
    assert tuple(got) == (1, 1, 1, 1)
    assert tuple(packing.broken_rules(spark.createDataFrame([], cols), CAPS).first()) == (0, 0, 0, 0)


@pytest.mark.skipif(not os.path.isdir(packing.TOKENIZER_DIR), reason="no tokenizer")
def test_token_counts(spark):
    enc = packing.load_tokenizer()
    texts = ["", None, "招生 plan", "a" * 5000, "<|endoftext|>"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in packing.token_counts(df).collect()}
    assert got == {i: len(enc.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert enc.decode(enc.encode_ordinary("招生 plan")) == "招生 plan"


# --- 8: text statistics ---------------------------------------------------------

ALPHABET = "学校的了专业A b.c,。\n\n|<>\t 　12;、é㐂!?the and of "


@settings(max_examples=150, deadline=None)
@given(st.text(ALPHABET, max_size=120), st.lists(st.integers(1, 40), min_size=1, max_size=12), st.integers(0, 10))
def test_partials_merge(text, cuts, fold_at):
    chunks, at = [], 0
    for c in cuts:
        chunks.append(text[at : at + c])
        at += c
    chunks.append(text[at:])
    parts = [textstats.Partial.of(c) for c in chunks]
    k = min(fold_at, len(parts) - 1)

    def merged(ps):
        out = ps[0]
        for p in ps[1:]:
            out = out.merge(p)
        return out

    whole = textstats.whole_texts([text])[0].tolist()
    assert merged(parts).totals().tolist() == whole
    if k:  # any bracketing gives the same
        assert merged(parts[:k]).merge(merged(parts[k:])).totals().tolist() == whole


def test_long_pieces():
    for text in ("x" * 500 + " " * 300 + "。" + " " * 200 + "the " * 90, "的" * 700, ("学校 的。\n" * 50) + "a" * 400):
        for size in (7, 50, 97, 150):
            parts = [textstats.Partial.of(text[i : i + size]) for i in range(0, len(text), size)]
            out = parts[0]
            for p in parts[1:]:
                out = out.merge(p)
            assert out.totals().tolist() == textstats.whole_texts([text])[0].tolist()


def test_statistics(spark):
    rnd = random.Random(2)
    texts = ["".join(rnd.choices(ALPHABET, k=n)) for n in (0, 1, 30, 500, 3000)] + [None, "", " \n　", "这所学校的专业很多，我们都看过了。", "- 水利工程\n- 化工管理", "The office explained that a name change does not alter the courses."]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "x")], "doc_id long, text string, kind string")
    whole = sorted(map(str, textstats.text_statistics(df).collect()))
    assert whole == sorted(map(str, textstats.text_statistics(df, chunk=40, fan_in=3).collect()))
    kinds = {r["doc_id"]: r["kind"] for r in textstats.text_statistics(df).collect()}
    assert kinds[5] == kinds[6] == kinds[7] == "blank" and kinds[8] == kinds[10] == "prose" and kinds[9] == "apart"
    assert textstats.text_statistics(df.limit(0)).count() == 0 and len(whole) == len(texts) + 1


def test_words_of_every_line(spark):
    """Latin words count in Chinese lines too, in short and in long texts."""
    rnd = random.Random(5)
    texts = ["学校的专业很多，我们都看过了，学校的专业 the IoT and 班。\nIt is the end.", "我们用 the 方法来看这些学校的专业。"]
    texts += ["".join(rnd.choices([*"学校的了专业水利工程", " the", "And ", "x", "throughout", "\n", "。"], k=n)) for n in (40, 400)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for chunk in (textstats.CHUNK, 30):
        for r in textstats.text_statistics(df, chunk=chunk, fan_in=3).collect():
            t = texts[r["doc_id"]]
            latin, han = re.findall("[A-Za-z]+", t), re.findall("[\u3400-\u9fff]", t)
            n = len(latin) + len(han)
            common = sum(w.lower() in textstats.ENGLISH_COMMON for w in latin) + sum(c in textstats.CHINESE_COMMON for c in han)
            assert r["word_count"] == n and r["common_word_share"] == pytest.approx(common / n, abs=1e-6)
            assert r["mean_word_length"] == pytest.approx((len(han) + sum(map(len, latin))) / n, abs=1e-6)


@here
def test_labels(spark):
    """Agreement with the labels that both annotators share."""
    big = DATA.replace("sf0.001", "sf0.1")
    if not os.path.isdir(big):
        pytest.skip("no larger tables")
    labels = spark.read.parquet(f"{big}/doc_labels.parquet").groupBy("doc_id").agg(F.collect_set("doc_kind").alias("k"), F.count("*").alias("n")).where("size(k) = 1")
    got = queries.p8_stats(spark, big).join(labels, "doc_id").select("kind", F.col("k")[0].alias("k")).collect()
    right = sum((r["kind"] == "prose") == (r["k"] == "prose") for r in got)
    assert right / len(got) > 0.97


def test_unused_names():
    assert re.compile(r"^p\d+_")
    assert all(re.match(r"^p\d+_", n) for n in queries.QUERIES)
