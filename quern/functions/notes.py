"""Texts that tell how a result came about: built from parts, and parsed back."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Wording of result notes.
STRICT = "严格匹配：归一化后专业名完全一致"
COARSE = "核心名匹配：今年该专业与往年同校某条记录的核心名相同（核心名=去掉方向、校区等括号后的专业主干名），且往年只有这一条记录，按规则直接沿用它的线差"
FAMILY_NOTE = "（注：今年该专业与往年记录的核心名属大类↔具体关系（如「化学」对「化学类」），招生类别相同；同校该类别往年只有这一条记录，按规则沿用它的线差）"
COMPOSITE_NOTE = "另：今年是综合评价招生=高考分+大学校测+学业考复合录取，往年只有普通批=纯高考分录取，两类线差口径不同。"
SUBJECT_NOTE = "选科要求跨年不同，不影响匹配"
SINGLE_YEAR = "（仅一年数据，无标准差）"
JUDGED = "agent 语义匹配"
JUDGED_NONE = "agent 判断：没找到语义相同的往年专业"
DELETED = "往年有这个专业，今年该校停招了"
FLIGHT = "飞行技术(军队)类专业，无法匹配"
SPECIAL = "未能匹配：详见未能匹配的专业表"
OUT_OF_SCOPE = "专科：不在本次整理范围（仅本科）"
DEMOTED = "二次复核认为可能有误"
MISS = "未命中"
NEW_SCHOOL = "2026 新增校，近三年无招生"
GONE_SCHOOL = "学校未在 2026 招生"
NO_HISTORY = "新校/无历史，无法估算"

# Labels before the colon, and beginnings without one.
STAGES = ("严格匹配", "核心名匹配", "agent 语义匹配", "新增专业", "未能匹配", DEMOTED, "专科")
KEYWORD_STAGES = (("这所学校可能改了名字", "可能改名的学校"), ("这所学校今年没有在山东招生", "停招消失"), ("往年有这个专业", "往年今年停招"), ("新校", "新校无历史"), ("整校近三年无数据", "新校无历史"))
RESULT_HEADERS = ("匹配方式", "仅一年数据", "选科要求跨年变化", "二次复核", "原因说明")
LEVEL_LABELS = {0: "同校同选科均值", 1: "同校全专业均值", 2: "无法估算（新校无历史）"}

_ONE_MARK, _DRIFT_MARK = "（仅一年数据", "选科要求跨年不同"
_ENDS = "；，、 "


def single_year(t: Column) -> Column:
    """The note for a past row without a deviation, else ''."""
    return F.when(t.isNull(), F.lit(SINGLE_YEAR)).otherwise(F.lit(""))


def joined(*parts: Column) -> Column:
    """Non-empty parts with ；between them."""
    return F.array_join(F.filter(F.array(*parts), lambda p: F.coalesce(p, F.lit("")) != ""), "；")


def cross_category(school: Column, past_cat: Column, j: Column, cat: Column, major: Column) -> Column:
    """Note of a match with the only past row, in another category."""
    named = lambda c: F.when(F.coalesce(c, F.lit("")) == "", F.lit("普通")).otherwise(c)
    text = F.concat(
        F.lit("（【跨招生类别·一对多兜底】往年"), school, F.lit("该专业只招过 1 条记录、招生类别是「"), named(past_cat), F.lit("」（线差 J="),
        F.coalesce(j.cast("string"), F.lit("None")), F.lit("）；今年这条是「"), named(cat),
        F.lit("」。招生类别不同=不同专业、不同分数线，但往年只此 1 条，按一对多兜底配它、J 仅作参考，不等于今年该类别的真实门槛。）"),
    )
    composite = F.coalesce(cat, F.lit("")).contains("综合评价") | F.coalesce(major, F.lit("")).contains("综合评价")
    return F.concat(text, F.when(composite, F.lit(COMPOSITE_NOTE)).otherwise(F.lit("")))


def _without_marks(note: Column) -> Column:
    once = F.regexp_replace(note, f"(?s)^(.*?){_ONE_MARK}[^）]*(?:）|$)", "$1")
    return F.btrim(F.regexp_replace(once, f"(?s)^(.*?){_DRIFT_MARK}.*?不影响匹配", "$1"), F.lit(_ENDS))


def split_log(log: Column) -> Column:
    """A note as a struct of five texts: stage, single-year flag, subject-drift
    flag, second look, reason. An unknown text is kept as the reason; NULL and
    '' give five empty texts."""
    text = F.trim(F.coalesce(log, F.lit("")))
    stage, note = F.lit(""), text
    for begin, label in reversed(KEYWORD_STAGES):
        stage = F.when(text.startswith(begin), F.lit(label)).otherwise(stage)
    for label in reversed(STAGES):
        here = text.startswith(label + "：")
        rest = _without_marks(F.substring(text, F.lit(len(label) + 2), F.length(text)))
        shown, kept = (F.lit("专科（超范围）"), F.lit("")) if label == "专科" else (F.lit(label), rest)
        stage, note = F.when(here, shown).otherwise(stage), F.when(here, kept).otherwise(note)
    flag = lambda mark: F.when(text.contains(mark), F.lit("是")).otherwise(F.lit(""))
    second = F.when(stage == JUDGED, F.lit("确定")).otherwise(F.lit(""))
    values = (stage, flag(_ONE_MARK), flag(_DRIFT_MARK), second, note)
    return F.struct(*[v.alias(h) for v, h in zip(values, RESULT_HEADERS)])


def official_url(text: Column) -> Column:
    """The first URL of a government site in a text, or ''."""
    urls = F.filter(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"https?://[^\s)）]+"), 0), lambda u: u.contains(".gov.cn"))
    return F.coalesce(F.get(urls, F.lit(0)), F.lit(""))


def has_official_link(*cells: Column) -> Column:
    return F.concat_ws(" ", *cells).rlike(r"moe\.gov\.cn|gov\.cn|\.edu\.cn")


# Words that mark a line of a research text as its conclusion.
CONCLUSION_WORDS = ("前身", "更名", "原名", "转设", "合并", "升格", "揭牌", "教育部", "由")


def research_summary(text: Column, school: Column) -> Column:
    """The longest concluding line (100 characters at most, the first of equals)
    and the official source; a pointer where there is neither."""
    lines = F.split(F.coalesce(text, F.lit("")), r"\r?\n")
    clean = F.transform(lines, lambda s: F.trim(F.regexp_replace(F.regexp_replace(F.trim(s), "^-+", ""), "^#+", "")))
    told = F.filter(clean, lambda s: (s != "") & ~F.substring(s, 1, 8).contains("查询") & s.rlike("|".join(CONCLUSION_WORDS)))
    longest = F.aggregate(told, F.lit(""), lambda a, s: F.when(F.length(s) > F.length(a), s).otherwise(a))
    url = official_url(text)
    parts = F.filter(F.array(F.substring(longest, 1, 100), F.when(url != "", F.concat(F.lit("来源："), url)).otherwise(F.lit(""))), lambda p: p != "")
    return F.when(F.size(parts) > 0, F.array_join(parts, " ")).otherwise(F.concat(F.lit("（见 research/"), school, F.lit(".md）")))


def rename_query(new: Column, old: Column) -> Column:
    return F.concat_ws(" ", new, old, F.lit("更名 转设 前身 同源 高校"))


def merge_remark(summary: Column, remark: Column, reviewed: Column) -> Column:
    """A reviewed remark stays; otherwise the summary is added on its own line."""
    s, r = F.trim(F.coalesce(summary, F.lit(""))), F.trim(F.coalesce(remark, F.lit("")))
    merged = F.when(s == "", r).when(r == "", s).otherwise(F.concat(r, F.lit("\n"), s))
    return F.when(F.coalesce(reviewed, F.lit(False)), remark).otherwise(merged)


# What judges are told, in this project's words.
RULE = (
    "按往年记录的条数判断：同校同招生类别同核心名往年只有一条时，今年的写法、培养模式、方向、性别、标点不同仍是同一专业，选这一条；"
    "往年有多条时，选名称、方向、培养模式都相同的那一条，没有就填 null。候选之外的名称一律不选；选中时照抄候选的 J 和 T。"
)
ASK_ONE = (
    "请判断这对专业是否确定。往年该校此核心名只有一条记录，说明只招过一个专业：今年换了培养模式标签（拔尖、卓越、创新、英才、基地、试验班、订单班等），"
    "改了方向措辞、中外合作、性别、标点、词序或括号，都还是它，判「确定」。"
)
ASK_MANY = (
    "请判断这对专业是否确定。往年该校此核心名有多条记录，说明它们分开招生、各有分数线：培养模式标签、出国培养、中外合作、师范、招生类别、学制、"
    "单独划线的校区或真正的方向有实质不同，判「存疑」；只是体检、色盲、学费、语种、章程、词序、标点等描述不同，判「确定」。"
)
ASK_TAIL = (
    "大类与其具体专业（只差「类」字，往年大类确实包含今年的专业）判「确定」，线差作参考；工科试验班类这样的混合大类判「存疑」。"
    "同一所大学的校区标注不影响；单独划线的办学点或两所不同的学校不该相配，判「存疑」。专业本身不同、招生类别不同、学制不同，判「存疑」。拿不准判「存疑」。"
)
RENAME_TASK = (
    "# 学校更名判断\n\nrename_candidates 中每行是一所只在今年出现的学校和可能的旧校名，按名称相似度排列；相似度只作参考。\n"
    "请查明它是否由某所旧校更名、转设或合并而来，以教育部、省教育厅或学校官网为准。\n\n"
    "每对写一行 JSON 到 rename_result.jsonl：new_school、old_school、confidence（0 到 1）、is_rename（true 或 false）、note（依据与官方链接）。\n"
    "没有旧校时 is_rename 为 false，old_school 可为空。不要改动候选文件。\n"
)


def requirement(past_rows: Column, one: str = ASK_ONE, many: str = ASK_MANY, tail: str = ASK_TAIL) -> Column:
    """The question for a second look, by the number of past rows."""
    return F.concat(F.when(past_rows <= 1, F.lit(one)).otherwise(F.lit(many)), F.lit(tail))
