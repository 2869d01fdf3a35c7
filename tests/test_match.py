"""The matching cascade against naive loops and the end-to-end fixture."""

import json
import os
import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from quern.functions import notes
from quern.operators import contracts, match, order, results, schools
from quern.operators.estimate import INTENDED_VARIANTS, estimate
from quern.plans import pipeline
from quern.sources import files, grids
from quern.sources.xlsx import read_rows, read_xlsx, sheet_names, write_rows, write_xlsx

P = "src_row_idx int, school string, school_cat string, major string, stripped string, core string, subject string, batch string"
H = "hist_pos long, school string, school_cat string, major string, stripped string, core string, subject string, J double, T double, source_table string"


def plan_row(i, school, cat, core, subject="", major=None):
    return (i, school, cat, major or core, major or core, core, subject, "b")


def past_row(i, school, cat, core, j=1.0, t=None, subject="", major=None):
    return (i, school, cat, major or core, major or core, core, subject, j, t, "s")


def random_sides(spark, seed, n=60, m=50):
    rnd = random.Random(seed)
    cores, cats, subjects = ["数", "数类", "数类类", "化", "化类", ""], ["", "普通计划", "走读"], ["", "物", "物和化", "物 | 化"]
    plan = [plan_row(i, rnd.choice("ABC"), rnd.choice(cats), rnd.choice(cores), rnd.choice(subjects)) for i in range(1, n)]
    past = [past_row(i, rnd.choice("ABCD"), rnd.choice(cats), rnd.choice(cores), rnd.choice([None, 1.0, 2.5, 60.0]), rnd.choice([None, 1.0]), rnd.choice(subjects), rnd.choice(["x", "y", "z"])) for i in range(m)]
    return plan, past, spark.createDataFrame(plan, P), spark.createDataFrame(past, H)


def fold(c):
    return "" if c == "普通计划" else c


def compatible(a, b):
    return bool(a) and bool(b) and (a == b or a + "类" == b or b + "类" == a)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_coarse_naive(spark, seed):
    plan, past, p, h = random_sides(spark, seed, m=12 + 8 * seed)
    got = {r["src_row_idx"]: (r["step"], r["J"], r["T"], r["matched_major"]) for r in match.coarse_match(p, h).collect()}
    want = {}
    for d in plan:
        pools = [
            [x for x in past if x[1] == d[1] and fold(x[2]) == fold(d[2]) and x[5] == d[5]],
            [x for x in past if x[1] == d[1] and fold(x[2]) == fold(d[2]) and compatible(d[5], x[5])],
            [x for x in past if x[1] == d[1] and compatible(d[5], x[5])],
        ]
        for step, pool in enumerate(pools, 1):
            if len(pool) == 1:
                want[d[0]] = (step, pool[0][7], pool[0][8], pool[0][3])
                break
    assert got == want and got


@pytest.mark.parametrize("seed", [4, 5])
def test_locate_naive(spark, seed):
    plan, past, p, h = random_sides(spark, seed)
    rnd = random.Random(seed)
    ms = [(d[0], rnd.choice(["x", "y", None]), rnd.choice([None, 1.0, 2.4, 60.0]), rnd.choice([None, 1.0])) for d in plan]
    got = {r["src_row_idx"]: (r["level"], r["hist_pos"]) for r in match.locate_past(spark.createDataFrame(ms, "src_row_idx int, matched_major string, J double, T double"), p, h).collect()}
    by = {d[0]: d for d in plan}
    want = {}
    for i, name, j, t in ms:
        d = by[i]
        same = [x for x in past if x[1] == d[1]]
        core = [x for x in same if x[5] == d[5]]
        if name and (hit := next((x for x in same if x[3] == name), None)):
            want[i] = (1, hit[0])
        elif hit := next((x for x in core if x[7] == j and x[8] == t), None):
            want[i] = (2, hit[0])
        elif len(core) == 1:
            want[i] = (3, core[0][0])
        elif core and j is not None:
            near = min(core, key=lambda x: (abs((x[7] or 0) - j), x[0]))
            if abs((near[7] or 0) - j) <= 0.5:
                want[i] = (4, near[0])
    assert got == want and got


@pytest.mark.parametrize("variants", [" \\| ", INTENDED_VARIANTS])
def test_estimate_naive(spark, variants):
    import re

    plan, past, p, h = random_sides(spark, 7)
    plan.append(plan_row(999, "Z", "", "数"))
    got = {r["src_row_idx"]: (r["value"], r["T"], r["level"], r["n"]) for r in estimate(spark.createDataFrame(plan, P), h, variants=variants).collect()}
    atoms = lambda s: {x for x in s.strip().split("和") if x}
    covers = lambda a, b: True if not a.strip() else bool(b.strip()) and any(atoms(a) <= atoms(v) for v in re.split(variants, b))
    mean = lambda xs: round(sum(xs) / len(xs), 2) if xs else None
    for d in plan:
        same = [x for x in past if x[1] == d[1]]
        fit = [x for x in same if covers(d[6], x[6])]
        for level, pool in enumerate((fit, same)):
            js = [x[7] for x in pool if x[7] is not None]
            if js:
                v, t, lv, n = got[d[0]]
                assert (lv, n) == (level, len(js)) and abs(v - mean(js)) <= 0.011
                assert t == mean([x[8] for x in pool if x[8] is not None])
                break
        else:
            assert got[d[0]] == (None, None, 2, 0)


def test_strict(spark):
    p = spark.createDataFrame([plan_row(1, "A", "普通计划", "数"), plan_row(2, "A", "走读", "数"), plan_row(3, "", "", ""), plan_row(4, "A", None, "化")], P)
    h = spark.createDataFrame([past_row(9, "A", "", "数", 5.0, 1.0), past_row(3, "A", "普通计划", "数", 6.0, None, major="数"), past_row(5, "A", None, "化", None)], H)
    got = {r["src_row_idx"]: (r["matched"], r["J"], r["log"]) for r in match.strict_match(p, h).collect()}
    assert got == {1: (True, 6.0, notes.STRICT + "；" + notes.SINGLE_YEAR), 2: (False, None, notes.MISS), 3: (False, None, notes.MISS), 4: (True, None, notes.STRICT + "；" + notes.SINGLE_YEAR)}
    assert match.unmatched(p, match.strict_match(p, h)).count() == 2
    empty = spark.createDataFrame([], H)
    assert match.strict_match(p, empty).where("matched").count() == 0
    assert match.coarse_match(p, empty).count() == 0 and match.candidates(p, empty).count() == 0


def test_positions(spark):
    df = spark.createDataFrame([(i * 7 % 101, f"x{i}") for i in range(101)], "k int, v string")
    assert {r["k"]: r["pos"] for r in order.positions(df, ["k"]).collect()} == {i: i + 1 for i in range(101)}
    sizes = [r["count"] for r in order.batches(df, ["k"], 20).groupBy("batch_no").count().orderBy("batch_no").collect()]
    assert sizes == [20, 20, 20, 20, 20, 1]
    assert order.batches(df, ["k"], 0).select("batch_no").distinct().count() == 1
    a, b = (sorted(r["k"] for r in order.stable_sample(df.repartition(n), "k", 9).collect()) for n in (1, 7))
    assert a == b and len(a) == 9


def test_schools(spark):
    p = spark.createDataFrame([plan_row(1, "新大", "", "数"), plan_row(2, "老大", "", "数"), plan_row(3, "独", "", "化")], P)
    h = spark.createDataFrame([past_row(1, "新大学院", "", "数"), past_row(2, "老大", "", "化"), past_row(3, "老大", "", "化")], H)
    assert {r["school"]: r["major_count"] for r in schools.new_schools(p, h).collect()} == {"新大": 1, "独": 1}
    assert {r["school"] for r in schools.gone_schools(p, h).collect()} == {"新大学院"}
    assert [r["hist_pos"] for r in schools.deleted_majors(p, h).orderBy("hist_pos").collect()] == [2, 3]
    ren = spark.createDataFrame([("新大学院", "X", 1), ("新大学院", "新大", 2)], "old_school string, new_school string, pos long")
    assert {r["school"] for r in schools.apply_renames(h, ren).collect()} == {"新大", "老大"}
    c = schools.rename_candidates(p, h, topk=1).collect()
    assert [(r["new_school"], r["old_school"], r["place"]) for r in c] == [("新大", "新大学院", 1)]
    o = schools.rename_overlap(spark.createDataFrame([("新大", "新大学院")], "new_school string, old_school string"), p, h).first()
    assert (o["shared"], o["smaller"], o["overlap"]) == (1, 1, 1.0)


@pytest.mark.parametrize("blocks", [{}, {"new_block": 2, "old_block": 3}])
def test_rename_candidates(spark, blocks):
    """All pairs are ranked, whether or not they share neighbouring characters."""
    new = ["晓沅祁民航学院", "盛嵩安水利学院", "雀谷望电力大学", "甲", "乙丙丁"]
    old = ["峰柳隆海洋大学", "霖景露医药大学", "德汾景师范学院", "晓沅海运学校", "学院民航", "大电力谷", "戊", "丁乙", "丙x丁", "学大"]
    p = spark.createDataFrame([plan_row(i, s, "", "数") for i, s in enumerate(new)], P)
    h = spark.createDataFrame([past_row(i, s, "", "数") for i, s in enumerate(old)], H)
    ranked = {a: sorted((-SequenceMatcher(None, a, b).ratio(), b) for b in old) for a in new}
    for topk in (0, 1, 5):
        got = schools.rename_candidates(p, h, topk=topk, **blocks).collect()
        want = [(a, i, b, -x) for a, bs in ranked.items() for i, (x, b) in enumerate(bs[: topk or None], 1) if x < 0 or not topk]
        assert sorted((r["new_school"], r["place"], r["old_school"], r["similarity"]) for r in got) == sorted(want)
    assert schools.rename_candidates(p, h, topk=0, measure="edit", **blocks).count() == len(new) * len(old)
    assert schools.rename_candidates(p, h.limit(0), topk=0, **blocks).count() == 0


# --- contracts ---------------------------------------------------------------


def lines(spark, values):
    return spark.createDataFrame([("f", i, v) for i, v in enumerate(values, 1)], "file string, lineno int, value string")


def test_verdict_contract(spark):
    good = lambda **x: json.dumps({"src_row_idx": 1, "verdict": "确定", "reason": "好"} | x, ensure_ascii=False)
    vs = [good(), "", "x", "[1]", '{"src_row_idx": 1}', good(src_row_idx="1"), good(src_row_idx=True), good(src_row_idx=9), good(), good(src_row_idx=2, verdict="?"), good(src_row_idx=3, reason=" "), good(src_row_idx=4, reason="长" * 50), good() + " junk"]
    sent = spark.createDataFrame([(1,), (2,), (3,), (4,)], "src_row_idx int")
    got = {r["lineno"]: (r["error"], r["reason"]) for r in contracts.check_verdicts(lines(spark, vs), sent).collect()}
    errors = {k: v[0] for k, v in got.items()}
    assert 2 not in errors and errors[1] is None and got[12] == (None, "长" * 30)
    assert errors[3].startswith("JSON") and errors[13].startswith("JSON") and errors[4].startswith("顶层") and "verdict,reason" in errors[5]
    assert errors[6] == errors[7] == "src_row_idx 不是整数" and errors[8].endswith("匹配集中") and errors[9] == "src_row_idx 重复出现"
    assert errors[10] == "verdict 不在允许集" and errors[11].startswith("reason")
    with pytest.raises(contracts.ContractError, match="10 errors"):
        contracts.raise_errors(contracts.check_verdicts(lines(spark, vs), sent))
    with pytest.raises(contracts.ContractError, match="^f:3: "):
        contracts.raise_errors(contracts.check_verdicts(lines(spark, vs), sent), first_only=True)


def test_judged_contract(spark):
    sent = spark.createDataFrame([(i,) for i in range(1, 10)], "src_row_idx int")
    allowed = spark.createDataFrame([(i, "数", 10 * i + k, 11.0 - k * 0.334, None) for i in range(1, 10) for k in (0, 1)], "src_row_idx int, major string, hist_pos long, J double, T double")
    row = lambda i, **x: json.dumps({"src_row_idx": i, "school": "", "major": "", "match": "数", "J": 10.666, "T": None, "reason": "r"} | x, ensure_ascii=False)
    vs = [row(1), row(2, J=11), row(3, J=5.0), row(4, match=None, J=7), row(5, match="化"), row(6, match=3), row(7, reason=""), row(1), row(8, T=1.0), row(9, J=11, T=1.0)]
    got = {r["lineno"]: r for r in contracts.check_judged(lines(spark, vs), sent, allowed).collect()}
    assert (got[1]["error"], got[1]["hist_pos"]) == (None, 11) and (got[2]["error"], got[2]["hist_pos"]) == (None, 20)
    assert got[3]["error"] == "J 与候选不一致" and got[4]["error"] is None and got[4]["match"] is None
    assert got[5]["error"] == "match 不在候选集内" and got[6]["error"].startswith("match 既非") and got[7]["error"].startswith("reason") and got[8]["error"].endswith("重复出现") and got[9]["error"] == "J 与候选不一致" and got[10]["error"] == "T 与候选不一致"


def test_rename_contract(spark):
    only = spark.createDataFrame([("新",), ("新二",)], "school string")
    row = lambda **x: json.dumps({"new_school": "新", "old_school": "旧", "confidence": 0.9, "is_rename": True} | x, ensure_ascii=False)
    vs = [row(note=" n "), row(is_rename="true"), row(confidence=True), row(confidence=2), row(new_school=""), row(is_rename=False, new_school="别", old_school=None), row(new_school="别"), row(old_school=None), row(), row(old_school="旧二")]
    got = [(r["error"], r["remark"]) for r in contracts.check_renames(lines(spark, vs), only).orderBy("lineno").collect()]
    e = [x[0] for x in got]
    assert got[0] == (None, "n") and e[1].startswith("is_rename") and e[2].startswith("confidence 不是") and e[3].startswith("confidence 不在") and e[4].startswith("new_school 为空")
    assert e[5] is None and e[6].startswith("new_school 不是") and e[7].startswith("is_rename=True") and e[8].endswith("重复出现") and e[9] is None


def test_decisions(spark, tmp_path):
    (tmp_path / "d.tsv").write_text("1\t0\ta\tb\n\n2\t-\tx\n3\t5\ty\nq\t1\tz\n1\t1\tlast\n4\n", encoding="utf-8")
    d = files.decisions(files.numbered_lines(spark, str(tmp_path), "d.tsv"))
    got = {r["src_row_idx"]: (r["cand"], r["reason"], r["error"]) for r in d.collect() if r["src_row_idx"]}
    assert got[1] == (1, "last", None) and got[2] == (None, "x", None) and got[3][0] == 5 and got[4][2] == "列数 <2"
    items = spark.createDataFrame([(i, "s", "m", [("数", "数", 1.0, None), ("化", "化", 2.0, 1.0)]) for i in (1, 2, 3, 7)], "src_row_idx int, school string, major string, candidates array<struct<major string, core string, J double, T double>>")
    out = {r["src_row_idx"]: (r["match"], r["J"], r["error"]) for r in contracts.resolve_decisions(items, d).collect()}
    assert out == {1: ("化", 2.0, None), 2: (None, None, None), 3: (None, None, "cand 越界"), 7: (None, None, "缺 decision")}
    (tmp_path / "v.tsv").write_text("1\t确定\tok\n2\t?\tno\n", encoding="utf-8")
    v = files.verdict_decisions(files.numbered_lines(spark, str(tmp_path), "v.tsv"))
    assert {r["src_row_idx"]: r["error"] for r in contracts.resolve_verdicts(items, v).collect()} == {1: None, 2: "verdict 不在允许集", 3: "缺 decision", 7: "缺 decision"}


# --- workbooks and the whole run ----------------------------------------------


def test_xlsx(spark, tmp_path):
    path = str(tmp_path / "a.xlsx")
    write_rows(path, [("一", [["a", None, 1, 2.5], [], ["<&\"'>", " x ", True, "01"]]), ("说 明", [["k"]])])
    assert sheet_names(path) == ["一", "说 明"]
    assert list(read_rows(path)) == [(1, ["a", None, "1", "2.5"]), (2, []), (3, ["<&\"'>", " x ", "True", "01"])]
    df = read_xlsx(spark, path, columns=5)
    assert df.columns == ["_row_idx", "c0", "c1", "c2", "c3", "c4"]
    assert [tuple(r) for r in df.orderBy("_row_idx").collect()][0] == (1, "a", None, "1", "2.5", None)
    assert read_xlsx(spark, path, "说 明", 1).first()["c0"] == "k"
    out = str(tmp_path / "b.xlsx")
    write_xlsx(df.limit(0), out)
    assert list(read_rows(out)) == [(1, df.columns)]


HISTORY = [
    ["batch", "schoolcode", "schoolname", "majorname", "subject"],
    ["常规批一段线", "1", "示例大学", "计算机科学与技术", "物理和化学", "", "", "", "", 60, *[None] * 9, 5],
    ["常规批一段线", "1", "示例大学", "数学类", "物理", "", "", "", "", 70],
    ["常规批一段线", "1", "示例大学", "历史学", "物理和化学", "", "", "", "", 55, *[None] * 9, 4],
    ["常规批一段线", "2", "停招大学", "物理", "", "", "", "", "", 80, *[None] * 9, 3],
    ["常规批一段线", "3", "军航大学(地方专项计划)", "飞行技术", "", "", "", "", "", 50, *[None] * 9, 2],
    ["常规批二段线", "1", "示例大学", "弃", "", "", "", "", "", 1],
]
SUPPLEMENT = [["批次名称"], ["本科提前批A类", "普通计划", "4", "飞行大学", "1", "飞行技术", "", *[None] * 3, 501, *[None] * 3, 504, *[None] * 3, 503], ["专科提前批", "", "4", "飞行大学", "1", "x", "", *[None] * 3, 1]]
PLAN = [
    ["批次", "小标题", "学校代码", "学校名", "代号", "名称", "选考科目要求"],
    ["4.常规批"], ["4.常规批", "普通计划", "1", "示例大学"],
    ["4.常规批", "普通计划", "1", "示例大学", "01", "计算机科学与技术", "物理和化学"],
    ["4.常规批", "普通计划", "1", "示例大学", "02", "数学类(拔尖)", "物理"],
    ["4.常规批", "普通计划", "1", "示例大学", "03", "量子信息", "物理和化学"],
    ["4.常规批", "专科", "9", "专科大学", "01", "护理", ""],
    ["4.常规批", "普通计划", "5", "新校", "01", "人工智能", "物理"],
    ["1.提前批A类", "普通计划", "4", "飞行大学", "01", "飞行技术", ""],
    ["4.常规批", "普通计划", "3", "军航大学", "01", "飞行技术(军队)", ""],
]


@pytest.fixture
def workbooks(tmp_path):
    write_rows(str(tmp_path / "plan.xlsx"), [("表", PLAN)])
    write_rows(str(tmp_path / "hist.xlsx"), [("统计结果", HISTORY), ("说明", [["项目", "说明"], ["x", "low_score - 一段线；2023=443, 2024=444, 2025=441"]])])
    write_rows(str(tmp_path / "tq.xlsx"), [("表", SUPPLEMENT)])
    return pipeline.Config(str(tmp_path / "plan.xlsx"), str(tmp_path / "hist.xlsx"), str(tmp_path / "tq.xlsx"))


def test_run(spark, workbooks, tmp_path):
    out = pipeline.run(spark, workbooks)
    main = {r["src_row_idx"]: r for r in out["main"].collect()}
    assert sorted(main) == [4, 5, 6, 8, 9, 10]
    stage = {i: notes_stage(spark, r["log"]) for i, r in main.items()}
    assert (main[4]["J"], main[4]["T"], stage[4]) == (60.0, 5.0, "严格匹配")
    assert (main[5]["J"], main[5]["T"], stage[5]) == (70.0, None, "核心名匹配") and notes.SINGLE_YEAR in main[5]["log"] and notes.SUBJECT_NOTE not in main[5]["log"]
    assert (main[6]["matched"], main[6]["J"], main[6]["T"]) == (False, 57.5, 4.5)
    assert main[8]["J"] is None and main[8]["log"] == notes.NO_HISTORY
    assert (main[9]["J"], main[9]["T"]) == (60.0, 0.0)
    assert (main[10]["J"], main[10]["T"]) == (50.0, 2.0) and "跨招生类别" in main[10]["log"]
    assert out["coverage"].first().asDict() == {"total": 6, "matched": 4, "new_major": 2, "special": 0, "deleted": 3, "new_school": 1, "gone_school": 1, "rename": 0}
    assert out["hierarchical"].count() == len(PLAN) and out["flat"].count() == 6
    report = {r["name"]: r["passed"] for r in pipeline.audit(out, None).collect()}
    assert report["judgmental_coverage"] is False and report["nonempty_log"] and report["jt_consistency"] and report["rename_official_link"]
    assert pipeline.prompts(out, str(tmp_path / "j")) == 0
    pipeline.publish(out, str(tmp_path / "out"), workbooks=True)
    assert [r for _, r in read_rows(str(tmp_path / "out" / "今年新招生的学校.xlsx"))] == [["新校名", "今年本科专业数", "说明"], ["新校", "1", notes.NEW_SCHOOL]]


def notes_stage(spark, log):
    return spark.createDataFrame([(log,)], "x string").select(notes.split_log(F.col("x"))["匹配方式"]).first()[0]


def test_run_with_judge(spark, workbooks, tmp_path):
    """Two candidates go out, a pick comes back, and a second look demotes it."""
    more = [*HISTORY, ["常规批一段线", "1", "示例大学", "英语(师范)", "", "", "", "", "", 40, *[None] * 9, 1], ["常规批一段线", "1", "示例大学", "英语(商务)", "", "", "", "", "", 45, *[None] * 9, 1], ["常规批一段线", "6", "旧名大学", "化学", "", "", "", "", "", 33, *[None] * 9, 1]]
    write_rows(workbooks.history, [("统计结果", more)])
    write_rows(workbooks.plan, [("表", [*PLAN, ["4.常规批", "普通计划", "1", "示例大学", "04", "英语(翻译)", ""], ["4.常规批", "", "6", "新名大学", "01", "化学", ""]])])
    folder = tmp_path / "judged"
    folder.mkdir()
    workbooks.judged_dir = str(folder)
    (folder / "rename_result.jsonl").write_text(json.dumps({"new_school": "新名大学", "old_school": "旧名大学", "confidence": 0.9, "is_rename": True, "note": "https://www.moe.gov.cn/x"}, ensure_ascii=False), encoding="utf-8")
    out = pipeline.run(spark, workbooks)
    assert pipeline.prompts(out, str(folder)) == 1
    doc = json.loads((folder / "batch_01_prompt.json").read_text(encoding="utf-8"))
    assert [i["src_row_idx"] for i in doc["items"]] == [11] and [c["major"] for c in doc["items"][0]["candidates"]] == ["英语(师范)", "英语(商务)"]
    assert files.prompt_items(spark, str(folder)).count() == 1
    main = {r["src_row_idx"]: r for r in out["main"].collect()}
    assert main[12]["J"] == 33.0 and out["renamed"].first()["remark"] == "https://www.moe.gov.cn/x"
    (folder / "batch_01_result.jsonl").write_text(json.dumps({"src_row_idx": 11, "school": "", "major": "", "match": "英语(商务)", "J": 45.0, "T": 1.0, "reason": "近"}, ensure_ascii=False) + "\n\n", encoding="utf-8")
    out = pipeline.run(spark, workbooks)
    main = {r["src_row_idx"]: r for r in out["main"].collect()}
    assert (main[11]["J"], main[11]["log"]) == (45.0, "agent 语义匹配：近")
    assert pipeline.second_look_prompts(out, str(folder)) == 1
    (folder / "verify_01_result.jsonl").write_text(json.dumps({"src_row_idx": 11, "verdict": "存疑", "reason": "不像"}, ensure_ascii=False), encoding="utf-8")
    out = pipeline.run(spark, workbooks)
    main = {r["src_row_idx"]: r for r in out["main"].collect()}
    assert main[11]["J"] is None and main[11]["log"] == notes.SPECIAL
    special = {r["src_row_idx"]: r["log"] for r in out["special"].collect()}
    assert special == {11: notes.DEMOTED + "：不像"}
    verdicts = files.verdict_map(files.numbered_lines(spark, str(folder), "verify_*_result.jsonl"))
    assert {r["name"]: r["passed"] for r in pipeline.audit(out, verdicts).collect()}["judgmental_coverage"] is True


def test_files(spark, tmp_path):
    (tmp_path / "甲.md").write_text("由乙更名", encoding="utf-8")
    assert [tuple(r) for r in files.research_texts(spark, str(tmp_path)).collect()] == [("甲", "由乙更名")]
    assert files.numbered_lines(spark, str(tmp_path), "no_*.jsonl").count() == 0 and files.file_count(spark, str(tmp_path), "no_*") == 0
    before = files.digests(spark, [str(tmp_path / "甲.md")]).collect()
    import hashlib

    assert before[0]["sha256"] == hashlib.sha256("由乙更名".encode()).hexdigest()
    (tmp_path / "甲.md").write_text("x", encoding="utf-8")
    with pytest.raises(RuntimeError):
        files.assert_unchanged(before, files.digests(spark, [str(tmp_path / "甲.md")]).collect())
    files.write_json_lines(spark.createDataFrame([(1, None)], "a int, b string"), str(tmp_path / "j"))
    text = "".join(open(os.path.join(tmp_path / "j", f)).read() for f in os.listdir(tmp_path / "j") if f.endswith(".txt"))
    assert text.strip() == '{"a":1,"b":null}'
    files.write_csv(spark.createDataFrame([(1, "x")], "a int, b string"), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).first()["b"] == "x"
    v = spark.createDataFrame([(1, "a", None), (2, "b", "学院")], "_row_idx int, x string, y string")
    assert [r["line"] for r in files.view(v, head=1).collect()] == ["a\t"] and [r["line"] for r in files.view(v, grep="学院").collect()] == ["b\t学院"]


def test_notes_scan(spark):
    g = spark.createDataFrame([(1, "x", "一段线 2023=1"), (2, None, "一段线；2023 = 443，2024=444")], "_row_idx int, c0 string, c1 string")
    assert grids.cutoffs_from_notes(g) == {2023: 443, 2024: 444} and grids.cutoffs_from_notes(g.limit(0)) is None


def test_stream(spark, tmp_path):
    from quern.streaming.results import verdict_sink

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "verify_1_result.jsonl").write_text('{"src_row_idx": 1, "verdict": "确定", "reason": "r"}\n{"src_row_idx": 5, "verdict": "确定", "reason": "r"}\n', encoding="utf-8")
    q = verdict_sink(spark, str(tmp_path / "in"), spark.createDataFrame([(1,)], "src_row_idx int"), str(tmp_path / "out"), str(tmp_path / "cp"))
    q.awaitTermination(120)
    got = {r["src_row_idx"]: r["error"] for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[1] is None and got[5].endswith("匹配集中")


def test_blank_cells(spark):
    p = spark.createDataFrame([(1, None, None, None, None, None, None, None)], P)
    h = spark.createDataFrame([(1, None, None, None, None, None, None, None, None, None)], H)
    assert match.strict_match(p, h).first()["matched"] is False
    assert results.core_groups(h).count() == 0 and estimate(p, h).first()["level"] == 2


def test_command_line(spark, workbooks, tmp_path, capsys):
    from quern.__main__ import int_map, main, names

    assert int_map("2025=441, 2024=444") == {2025: 441, 2024: 444} and names("a, b,") == ("a", "b")
    base = ["--plan", workbooks.plan, "--history", workbooks.history, "--supplement", workbooks.supplement, "--out", str(tmp_path / "o"), "--judged-dir", str(tmp_path / "j")]
    (tmp_path / "j").mkdir()
    assert main(["run", *base, "--workbooks"]) == 0 and main(["audit", *base]) == 1
    assert main(["show", workbooks.plan, "--grep", "量子"]) == 0 and "量子信息" in capsys.readouterr().out
    (tmp_path / "p").mkdir()
    doc = {"batch": 1, "items": [{"src_row_idx": 7, "school": "s", "major": "m", "candidates": [{"major": "数", "core": "数", "J": 1.0, "T": None}]}]}
    (tmp_path / "p" / "batch_01_prompt.json").write_text(json.dumps(doc, ensure_ascii=False), encoding="utf-8")
    (tmp_path / "d.tsv").write_text("7\t0\t像\n", encoding="utf-8")
    assert main(["decide", "--prompts", str(tmp_path / "p"), "--pattern", "batch_*_prompt.json", "--tsv", str(tmp_path / "d.tsv"), "--out", str(tmp_path / "r")]) == 0
    text = "".join(open(os.path.join(tmp_path / "r", f), encoding="utf-8").read() for f in os.listdir(tmp_path / "r") if f.endswith(".txt"))
    assert json.loads(text) == {"src_row_idx": 7, "school": "s", "major": "m", "match": "数", "J": 1.0, "T": None, "reason": "像"}
    (tmp_path / "d.tsv").write_text("7\t3\t像\n", encoding="utf-8")
    with pytest.raises(contracts.ContractError):
        main(["decide", "--prompts", str(tmp_path / "p"), "--pattern", "batch_*_prompt.json", "--tsv", str(tmp_path / "d.tsv"), "--out", str(tmp_path / "r")])


def test_numbered_lines_in_blocks(spark, tmp_path):
    """Line numbers are the same whether a file is read whole or in many blocks."""
    rnd = random.Random(3)
    want = []
    for f in range(4):
        lines = ["".join(rnd.choices("甲乙ab", k=rnd.randrange(0, 30))) for _ in range(rnd.randrange(0, 200))]
        with open(tmp_path / f"v_{f}.txt", "w", encoding="utf-8", newline="") as out:
            out.write(rnd.choice(["\n", "\r\n"]).join(lines))
        want += [(f"v_{f}.txt", i, x) for i, x in enumerate(lines, 1) if x]
    (tmp_path / "w.txt").write_text("other")
    for size in ("128m", "64b"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = [tuple(r) for r in files.numbered_lines(spark, str(tmp_path), "v_*.txt").collect() if r["value"]]
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted(got) == sorted(want)


def test_extra_checks(spark):
    from quern.operators import audit

    rows = spark.createDataFrame([(1, "甲", "数学"), (2, "甲", "数学(乙"), (3, None, "化学)"), (4, "丙", ""), (5, "丁", None)], "src_row_idx int, school string, core string")
    assert {r["src_row_idx"] for r in audit.residual_brackets(rows).collect()} == {2, 3}
    past = spark.createDataFrame([("甲", "数学类"), ("甲", "数学类"), ("乙", "数学类"), ("甲", "数学"), ("丙", "类"), (None, "化学)类")], "school string, core string")
    assert [tuple(r) for r in audit.unmatched_families(rows, past).collect()] == [(1, "数学", "数学类")]
    assert {r["src_row_idx"] for r in audit.uncovered(rows, past, ["school", "core"]).collect()} == {2, 3, 4, 5}
