import random
import unicodedata

import pytest
from pyspark.sql import functions as F

from quern.functions import lookalike, notes, numeric, similarity
from quern.functions import text as tx


def col(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("x"))).collect()]


def test_fold(spark):
    texts = [None, "", " 数 学\x1c", "ＡＢＣ（一）", "Ⅱ班", "a\xa0b c", "é"]
    want = ["".join(unicodedata.normalize("NFKC", t or "").split()) for t in texts]
    assert col(spark, texts, tx.fold) == want


@pytest.mark.parametrize(("raw", "base", "cat"), [("三亚学院(中外合作办学)", "三亚学院", "中外合作办学"), ("山东建筑大学（走读）", "山东建筑大学", "走读"), ("北京大学()", "北京大学", ""), ("甲(北京)", "甲(北京)", ""), ("甲(民族班)乙", "甲(民族班)乙", ""), (None, "", "")])
def test_split_school(spark, raw, base, cat):
    df = spark.createDataFrame([(raw,)], "x string")
    b, c = tx.split_school(tx.fold(F.col("x")))
    assert tuple(df.select(b, c).first()) == (base, cat)


def test_strip_asides(spark):
    names = ["英语(男,通用标准合格)", "英语(女)", "护理(无色盲色弱)(定向)", "侦查(男，身高170cm以上,面向临沂就业)", "甲(要求(色盲))乙", "x"]
    want = ["英语(男)", "英语(女)", "护理(定向)", "侦查(男,面向临沂就业)", "甲(要求)乙", "x"]
    assert col(spark, names, lambda x: tx.strip_asides(tx.fold(x))) == want


def test_core_name(spark):
    names = ["1+3(一年国内加三年(芬兰))", "数学类(拔尖)", "((a)(b))c", "a)b("]
    assert col(spark, names, lambda x: tx.core_name(tx.fold(x))) == ["1+3", "数学类", "c", "a)b("]


def test_brackets(spark):
    got = col(spark, ["甲(男)(中外合作)(低碳)", ""], tx.brackets)
    assert [[tuple(b) for b in g] for g in got] == [[("性别", "男"), ("合作", "中外合作"), ("其他", "低碳")], []]
    assert col(spark, ["甲(一二三四五六七八九十十一)", "乙"], tx.bracket_brief) == ["一二三四五六七八九十…", "无差异化括号"]
    assert col(spark, ["甲(a)", "甲(z)", "甲"], lambda x: tx.brackets_within(x, F.lit("乙(a)"))) == [True, False, True]


def test_categories(spark):
    assert col(spark, ["物理学(省属公费师范生,面向临沂就业)", "金融学(地方专项计划)", "化学"], tx.category_in_major) == ["省属公费师范生", "地方专项计划", ""]
    assert col(spark, ["普通计划", None, "走读"], tx.fold_category) == ["", "", "走读"]


def test_family_keys(spark):
    compatible = lambda a, b: bool(a) and bool(b) and (a == b or a + "类" == b or b + "类" == a)
    names = ["数学", "数学类", "数学类类", "类", "", "化学"]
    keys = dict(zip(names, col(spark, names, tx.family_keys)))
    for a in names:
        for b in names:
            assert (b in keys[a]) == compatible(a, b)


@pytest.mark.parametrize(("new", "past", "want"), [("物理和化学", "物理 | 物理和化学", True), ("", "", True), (None, "x", True), ("物理", "", False), ("物理", "化学", False), ("不限", "物理", False), ("物理", "物理|化学", False)])
def test_subject_covers(spark, new, past, want):
    df = spark.createDataFrame([(new, past)], "a string, b string")
    assert df.select(tx.subject_covers(F.col("a"), F.col("b"))).first()[0] is want
    if past == "物理|化学":
        assert df.select(tx.subject_covers(F.col("a"), F.col("b"), r"\s*\|\s*")).first()[0] is True


@pytest.mark.parametrize(("lows", "want"), [({2025: 524, 2024: 568, 2023: 500}, (88.0, 27.58)), ({2025: 500}, (59.0, None)), ({}, (None, None)), ({2025: None, 2024: 500}, (56.0, None)), ({2026: 9}, (None, None))])
def test_line_diff(spark, lows, want):
    j, t = numeric.line_diff({y: F.lit(v).cast("double") for y, v in lows.items()})
    assert tuple(spark.range(1).select(j, t).first()) == want


def test_numbers(spark):
    assert col(spark, [" 12 ", "", None, "x", "524"], numeric.number) == [12.0, None, None, None, 524.0]
    values = [2.675, 52.285, 1.005, -0.125, None]
    assert col(spark, values, numeric.exact_round2, "double") == [None if v is None else round(v, 2) for v in values]
    assert col(spark, [100.0, 1.5, 0.1234], numeric.short_number, "double") == ["100", "1.5", "0.1234"]
    df = spark.createDataFrame([(None, None), (1.0, None), (1.0, 1.01), (1.0, 1.02)], "a double, b double")
    assert [r[0] for r in df.select(numeric.close_number(F.col("a"), F.col("b"))).collect()] == [True, False, True, False]
    assert [r[0] for r in df.select(numeric.same_number(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]


def test_split_log(spark):
    logs = [
        "严格匹配：归一化后专业名完全一致；（仅一年数据，无标准差）", "核心名匹配：甲；选科要求跨年不同，不影响匹配；乙", "agent 语义匹配：像", "专科：不在本次整理范围（仅本科）", "新校/无历史，无法估算", "别的", "", None, "二次复核认为可能有误：x",
    ]
    got = [tuple(r) for r in col(spark, logs, notes.split_log)]
    assert got == [
        ("严格匹配", "是", "", "", "归一化后专业名完全一致"), ("核心名匹配", "", "是", "", "甲；；乙"), ("agent 语义匹配", "", "", "确定", "像"), ("专科（超范围）", "", "", "", ""),
        ("新校无历史", "", "", "", "新校/无历史，无法估算"), ("", "", "", "", "别的"), ("", "", "", "", ""), ("", "", "", "", ""), ("二次复核认为可能有误", "", "", "", "x"),
    ]


def test_research(spark):
    text = "# 查询语句 更名\n- 由甲学院更名而来\n短 前身\n来源 http://baike.example/x https://www.moe.gov.cn/a)b"
    df = spark.createDataFrame([(text, "乙"), (None, "丙")], "t string, s string")
    got = [r[0] for r in df.select(notes.research_summary(F.col("t"), F.col("s"))).collect()]
    assert got == ["由甲学院更名而来 来源：https://www.moe.gov.cn/a", "（见 research/丙.md）"]
    df = spark.createDataFrame([("s", "r", False), ("s", "r", True), ("", "r", False), ("s", None, None)], "s string, r string, m boolean")
    assert [r[0] for r in df.select(notes.merge_remark(F.col("s"), F.col("r"), F.col("m"))).collect()] == ["r\ns", "r", "r", "s"]


def test_similarity(spark):
    from difflib import SequenceMatcher

    df = spark.createDataFrame([("甲乙丙", "甲丙"), ("", None)], "a string, b string")
    assert [r[0] for r in df.select(similarity.ro_similarity(F.col("a"), F.col("b"))).collect()] == [SequenceMatcher(None, "甲乙丙", "甲丙").ratio(), 1.0]


def test_lookalike_key(spark):
    random.seed(1)
    pool = "工エ力カ口ロAΑА－-‐ ⼯金（(Éе́ЀⅡ​﻿\U000e0100、x "
    texts = ["".join(random.choices(pool, k=8)) for _ in range(300)] + ["", None, " a  b "]
    assert col(spark, texts, lookalike.key) == [lookalike.key_text(t) for t in texts]
    same = [("ＡＣＥ－ＴＯＰ", "ACE‐TOΡ"), ("化エ", "化⼯"), ("École", "É​cole"), ("　甲 ", "甲"), ("Ⅱ班", "II班")]
    for a, b in same:
        assert lookalike.key_text(a) == lookalike.key_text(b)
    assert lookalike.key_text("甲") != lookalike.key_text("乙")
