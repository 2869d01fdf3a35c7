"""Matching entities across sources without keys (problem 2).

Collective graph linkage:

1. Rows collapse to offers: (school, category, major, direction), all in
   look-alike form, so copies and spellings cost nothing later.
2. Two graphs of names, one of schools and one of majors. Two names share an
   attribute key if they are equal or one slip apart; an edge weighs its
   similarity times the rarity of the key it shares.
3. Meta-blocking: a name keeps the edges that come near the best weight at its
   end (weighted node pruning). A name that both sides know keeps itself alone;
   one that only one side knows keeps the names it may be a slip of.
4. Candidate pairs of offers: equal categories, schools and majors joined by
   edges that were kept, directions that don't contradict each other.
5. Propagation: a school name that may stand for several schools is judged by
   the share of its offers that each of them explains, and an offer by the
   schools it may belong to, again and again until the choice stands still. Then
   an offer keeps the majors with the best score.

All joins are equi-joins on compound keys; no group is ever collected.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.lookalike import key
from quern.session import at_most, salted_join, settle

# Fixed values of the task: endings of a direction's bracket, what begins a
# bracket with sub-majors, and the category that is none.
DIRECTION_ENDINGS = ("专业方向", "方向", "班")
CONTAINS = "含"
DEFAULT_CATEGORY = "普通计划"
# Fixed value: a long and a short wording of one ending (a parameter of link).
SHORT_WORDINGS = (("科学与技术", "科技"),)

OFFER = ["school", "cat", "stem", "direction"]
#: Words are looked up in a literal map up to this many, beyond it by a join.
LITERAL_WORDS = 300
ROUNDS = 100
#: An edge stays if it has this share of the best weight at its name.
PRUNE = 0.9
SLIP_SIMILARITY = 0.8
#: Factors of an offer pair's score: directions that aren't the same, and a
#: partner that has an equal major at the same school already.
OTHER_DIRECTION, TAKEN = 0.95, 0.9

_BRACKET = r"\(([^()]*)\)"


def bare(col: Column) -> Column:
    """A name without its brackets, however deep; an unclosed one runs to the end."""
    levels = F.length(col) - F.length(F.replace(col, F.lit("("), F.lit("")))
    out = F.aggregate(F.sequence(F.lit(0), levels), col, lambda acc, _: F.regexp_replace(acc, _BRACKET, ""))
    out = F.regexp_replace(F.regexp_replace(out, r"\(.*$", ""), r"[) ]", "")
    return F.when(col.rlike("[() ]"), out).otherwise(col)


def _inner(col: Column) -> Column:
    return F.transform(F.regexp_extract_all(col, F.lit(_BRACKET), 1), lambda x: F.replace(x, F.lit(" "), F.lit("")))


def _ended(word: Column) -> Column:
    return word.rlike("(?:" + "|".join(DIRECTION_ENDINGS) + ")$")


def direction_word(word: Column) -> Column:
    return F.lower(F.regexp_replace(word, "(?:" + "|".join(DIRECTION_ENDINGS) + ")$", ""))


def keyed(rows: DataFrame, row_id: str, side: str, wordings: Sequence[tuple[str, str]] = SHORT_WORDINGS) -> DataFrame:
    """(side, row_id, school, stem, words, own): bare school and major in
    look-alike form; the category and all bracketed words; how many of those
    words come before the major's brackets. Rows without school or major go."""
    s, m = key(F.col("school")), key(F.col("major"))
    c = F.replace(key(F.col("school_cat")), F.lit(" "), F.lit(""))
    first = rows.select(F.lit(side).alias("side"), F.col(row_id), s.alias("s"), m.alias("m"), F.coalesce(c, F.lit("")).alias("c"))
    stem = F.regexp_replace(bare(F.col("m")), "(?<=.)类$", "")
    for long, short in wordings:
        stem = F.regexp_replace(stem, f"{short}$", long)
    before = F.concat(F.array("c"), _inner(F.col("s")))
    out = first.select("side", row_id, bare(F.col("s")).alias("school"), stem.alias("stem"), F.concat(before, _inner(F.col("m"))).alias("words"), F.size(before).alias("own"))
    return out.where((F.col("school") != "") & (F.col("stem") != ""))


def category_names(values: DataFrame) -> DataFrame:
    """(word, means): a shortened category means the longest that contains it,
    the default one means none (''). Parts of every category meet the
    categories themselves, so the work grows with their number alone."""
    n = F.length("word")
    parts = F.flatten(F.transform(F.sequence(F.lit(1), n), lambda i: F.transform(F.sequence(i, n), lambda j: F.substring("word", i, j - i + 1))))
    longest = values.select(F.explode(F.array_distinct(parts)).alias("part"), "word").join(values.select(F.col("word").alias("part")), "part")
    best = longest.groupBy("part").agg(F.max_by("word", F.struct(F.length("word"), F.col("word"))).alias("best"))
    return best.select(F.col("part").alias("word"), F.when(F.col("part") == DEFAULT_CATEGORY, "").otherwise(F.col("best")).alias("means"))


def vocabulary(rows: DataFrame) -> DataFrame:
    """(word, means, kind) of all bracketed words that mean something: kind c
    for categories, kind d for directions. A direction is a word that stands
    with a direction's ending somewhere; its bare form then is one too."""
    values = rows.select(F.col("words")[0].alias("word")).where("word <> ''").distinct()
    cats = category_names(values).withColumn("kind", F.lit("c"))
    inner = F.explode(F.slice("words", F.col("own") + 1, F.greatest(F.size("words") - F.col("own"), F.lit(0))))
    words = rows.select(inner.alias("word")).distinct().where((F.col("word") != "") & ~F.col("word").startswith(CONTAINS)).join(values, "word", "left_anti")
    told = words.where(_ended(F.col("word"))).select(direction_word(F.col("word")).alias("means")).where("means <> ''").distinct()
    named = words.select("word", direction_word(F.col("word")).alias("means")).join(told, "means").select("word", "means", F.lit("d").alias("kind"))
    return cats.unionByName(named)


def looked_up(rows: DataFrame, words: str, known: DataFrame, limit: int = LITERAL_WORDS) -> DataFrame:
    """``rows`` with ``found``: for every word of the array its (means, kind),
    NULL where there is none."""
    few = at_most(known, limit)
    if few is not None:
        means = F.lit(None).cast("struct<means:string,kind:string>")
        if few:
            pairs = [x for r in few for x in (F.lit(r["word"]), F.struct(F.lit(r["means"]).alias("means"), F.lit(r["kind"]).alias("kind")))]
            table = F.create_map(*pairs)
            return rows.withColumn("found", F.transform(words, lambda w: F.try_element_at(table, w)))
        return rows.withColumn("found", F.transform(words, lambda w: means))
    lists = rows.select(words).distinct()
    each = lists.select(words, F.posexplode(words).alias("at", "word")).join(known, "word", "left")
    one = F.struct("at", F.when(F.col("kind").isNotNull(), F.struct("means", "kind")).alias("x"))
    found = each.groupBy(words).agg(F.transform(F.array_sort(F.collect_list(one)), lambda z: z["x"]).alias("found"))
    # rows with nothing in brackets have the same few lists
    return salted_join(rows, found, [words], "left", "stem")


def offers(rows: DataFrame, limit: int = LITERAL_WORDS) -> DataFrame:
    """Keyed rows with (cat, direction, o1, o2); '' where there is no category
    or direction. o1 and o2 are a 128-bit hash of the four, the offer's id."""
    found = looked_up(rows, "words", vocabulary(rows), limit)
    cat = F.filter("found", lambda x: (x["kind"] == "c") & (x["means"] != ""))
    major = F.slice("found", F.col("own") + 1, F.greatest(F.size("found") - F.col("own"), F.lit(0)))
    direction = F.filter(major, lambda x: x["kind"] == "d")
    out = found.withColumns({"cat": F.coalesce(F.get(cat, F.lit(0))["means"], F.lit("")), "direction": F.coalesce(F.get(direction, F.lit(0))["means"], F.lit(""))})
    four = [F.col(c) for c in OFFER]
    return out.drop("words", "own", "found").withColumns({"o1": F.xxhash64(*four), "o2": F.xxhash64(F.lit("2"), *four)})


def slip_keys(name: Column) -> Column:
    """Hashes of the name and of all its forms with one character left out, each
    with the place and the character; two names within one slip share a form."""
    n = F.length(name)
    form = lambda i: F.xxhash64(F.concat(F.substring(name, F.lit(1), i - 1), F.substring(name, i + 1, n)))
    cut = F.transform(F.sequence(F.lit(1), n), lambda i: F.struct(form(i).alias("k"), i.cast("int").alias("at"), F.substring(name, i, F.lit(1)).alias("ch")))
    return F.concat(F.array(F.struct(F.xxhash64(name).alias("k"), F.lit(0).alias("at"), F.lit("").alias("ch"))), cut)


def one_slip(a: str, b: str) -> Column:
    """Of two slip keys (struct columns) with the same form: whether the names
    behind them differ by one character left out or two neighbours exchanged."""
    left_out = (F.col(f"{a}.at") == 0) != (F.col(f"{b}.at") == 0)
    swapped = (F.col(f"{a}.at") > 0) & (F.col(f"{b}.at") > 0) & (F.abs(F.col(f"{a}.at") - F.col(f"{b}.at")) == 1) & (F.col(f"{a}.ch") == F.col(f"{b}.ch"))
    return left_out | swapped


def name_edges(names: DataFrame, prune: float = PRUNE) -> DataFrame:
    """(name, meant, similarity, weight): the names each name may stand for.

    ``names`` has (name, form, in_plan, in_past, told, n): a name, a form to
    compare it in (its own or another wording), the sides that know it, whether
    a rename tells of it, and its rows. Names of different sides share a key if
    they are equal or one slip apart. The rarer the key, the more an edge
    weighs; the rows of a slip's key include those of both its names, so a slip
    never weighs more than SLIP_SIMILARITY of an equal name. At each name the
    edges below ``prune`` of its best are cut.
    """
    forms = names.select("*", F.explode(slip_keys(F.col("form"))).alias("f")).withColumn("k", F.col("f.k"))
    total = names.agg(F.sum("n").alias("total"))
    rows = forms.groupBy("k").agg(F.sum("n").alias("rows"))
    rarity = F.log(1 + F.lit(float(total.first()[0] or 1)) / F.col("rows"))
    a = forms.select("k", "name", (F.col("form") == F.col("name")).alias("own"), "f", "in_plan", "in_past", "told")
    b = forms.select("k", F.col("name").alias("meant"), F.col("f").alias("g"), F.col("in_plan").alias("b_plan"), F.col("in_past").alias("b_past"), F.col("told").alias("b_told"))
    across = (F.col("in_plan") & F.col("b_past")) | (F.col("in_past") & F.col("b_plan")) | F.col("told") | F.col("b_told")
    slips = a.join(b, "k").where((F.col("name") != F.col("meant")) & across & one_slip("f", "g")).select("k", "name", "meant", F.lit(SLIP_SIMILARITY).alias("similarity"))
    known = a.where(F.col("own") & (F.col("f.at") == 0) & ((F.col("in_plan") & F.col("in_past")) | F.col("told"))).select("k", "name", F.col("name").alias("meant"), F.lit(1.0).alias("similarity"))
    weighed = slips.unionByName(known).join(rows, "k").groupBy("name", "meant").agg(F.max("similarity").alias("similarity"), F.max(F.col("similarity") * rarity).alias("weight"))
    best = F.max("weight").over(Window.partitionBy("name"))
    return weighed.withColumn("best", best).where(F.col("weight") >= F.lit(prune) * F.col("best")).drop("best")


def renames(rename_rows: DataFrame) -> DataFrame:
    """(old, new) for confirmed renames, in look-alike form, listed once."""
    return (
        rename_rows.where(F.col("is_rename"))
        .select(bare(key(F.col("old_school"))).alias("old"), bare(key(F.col("new_school"))).alias("new"))
        .where((F.col("old") != "") & (F.col("new") != "") & (F.col("old") != F.col("new")))
        .distinct()
    )


def rename_ends(renamed: DataFrame) -> DataFrame:
    """(old, end): the last name of every chain of renames; of names that are
    renamed in a circle the least."""
    following = renamed.select(F.col("old").alias("meant"), F.col("new").alias("next"))
    step, out = renamed.select("old", F.col("new").alias("meant"), F.array("old").alias("path")), None
    path = F.array_append("path", F.col("meant"))
    circle = F.array_contains(path, F.col("next"))
    while True:
        led = settle(step.join(following, "meant", "left"), "renames-led")
        least = F.array_min(F.slice(path, F.array_position(path, F.col("next")).cast("int"), F.size(path)))
        ended = led.where(F.col("next").isNull() | circle).select("old", F.when(F.col("next").isNull(), F.col("meant")).otherwise(least).alias("end"))
        out = ended if out is None else out.unionByName(ended)
        step = led.where(F.col("next").isNotNull() & ~circle).select("old", F.col("next").alias("meant"), path.alias("path"))
        if step.isEmpty():
            return out.distinct()


def _sides(kinds: DataFrame, column: str) -> DataFrame:
    """(name, in_plan, in_past, n) of the offers' schools or majors."""
    return kinds.groupBy(F.col(column).alias("name")).agg(
        F.bool_or(F.col("side") == "plan").alias("in_plan"), F.bool_or(F.col("side") == "past").alias("in_past"), F.sum("n").alias("n")
    )


def school_edges(kinds: DataFrame, renamed: DataFrame, prune: float = PRUNE) -> DataFrame:
    """(school, meant, similarity, weight): what each school's name may stand
    for. A renamed school stands for its last name, like any that means it."""
    told = renamed.select(F.col("old").alias("name")).unionByName(renamed.select(F.col("new").alias("name"))).distinct().withColumn("told", F.lit(True))
    no = F.lit(False)
    names = settle(_sides(kinds, "school").join(told, "name", "full_outer").select(
        "name", F.col("name").alias("form"), F.coalesce("in_plan", no).alias("in_plan"), F.coalesce("in_past", no).alias("in_past"), F.coalesce("told", no).alias("told"), F.coalesce("n", F.lit(1)).alias("n")
    ), "school-names")
    edges = name_edges(names, prune)
    itself = names.select("name", F.col("name").alias("meant"), F.lit(1.0).alias("similarity"), F.lit(0.0).alias("weight"))
    ends = rename_ends(renamed).withColumnRenamed("old", "meant")
    stands = edges.unionByName(itself).join(ends, "meant", "left").select(F.col("name").alias("school"), F.coalesce("end", "meant").alias("meant"), "similarity", "weight")
    return stands.groupBy("school", "meant").agg(F.max("similarity").alias("similarity"), F.max("weight").alias("weight"))


def major_edges(kinds: DataFrame, wordings: Sequence[tuple[str, str]] = SHORT_WORDINGS, prune: float = PRUNE) -> DataFrame:
    """(h_stem, p_stem, m_sim, m_weight): majors of the past and of the plan
    that may be the same. Slips are looked for in every wording of a name."""
    forms = [F.col("name")] + [F.regexp_replace("name", f"{long}$", short) for long, short in wordings]
    names = settle(_sides(kinds, "stem").withColumn("told", F.lit(False)).withColumn("form", F.explode(F.array_distinct(F.array(*forms)))), "major-names")
    edges = name_edges(names, prune).join(names.select("name", "in_plan", "in_past").distinct(), "name")
    cols = ["similarity", "weight"]
    past = edges.where("in_past").select(F.col("name").alias("h_stem"), F.col("meant").alias("p_stem"), *cols)
    plan = edges.where("in_plan").select(F.col("meant").alias("h_stem"), F.col("name").alias("p_stem"), *cols)
    return past.unionByName(plan).groupBy("h_stem", "p_stem").agg(F.max("similarity").alias("m_sim"), F.max("weight").alias("m_weight"))


def candidates(kinds: DataFrame, schools: DataFrame, majors: DataFrame) -> DataFrame:
    """Pairs of offers whose schools, majors, categories and directions agree."""
    plan = kinds.where("side = 'plan'").join(schools, "school").select(
        "meant", "cat", F.col("stem").alias("p_stem"), F.col("direction").alias("p_direction"), F.col("school").alias("p_school"), F.col("similarity").alias("p_sim"), F.col("o1").alias("p1"), F.col("o2").alias("p2")
    )
    past = kinds.where("side = 'past'").join(schools, "school").withColumnRenamed("stem", "h_stem").join(majors, "h_stem").select(
        "meant", "cat", "p_stem", "m_sim", F.col("direction").alias("h_direction"), F.col("school").alias("h_school"), F.col("similarity").alias("h_sim"), F.col("o1").alias("h1"), F.col("o2").alias("h2")
    )
    p, h = F.col("p_direction"), F.col("h_direction")
    pair = F.xxhash64("h_school", "p_school", "meant").alias("pair")
    edges = past.join(plan, ["meant", "cat", "p_stem"]).where((p == "") | (h == "") | (p == h))
    return edges.select("p1", "p2", "h1", "h2", "p_stem", "h_school", pair, (F.col("p_sim") * F.col("h_sim")).alias("start"), "m_sim", F.when(p == h, 1.0).otherwise(OTHER_DIRECTION).alias("d_sim"))


def propagate(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pair, score) of the pairs of schools that are in doubt.

    In doubt are the past school names with more than one partner, none of them
    certain. Each of their offers spreads over its candidates in proportion to
    their scores; a pair of schools takes up the share of the school's offers
    that fall to it. Both are repeated until every name's best partner stands
    still; if that hasn't happened within ``rounds``, it is an error.
    """
    pairs = edges.groupBy("h_school", "pair").agg(F.max("start").alias("start"))
    names = pairs.groupBy("h_school").agg(F.count(F.lit(1)).alias("n"), F.max("start").alias("best")).where("n > 1 AND best < 1")
    score = settle(pairs.join(names.select("h_school"), "h_school").withColumn("score", F.col("start")), "doubtful")
    if rounds < 1 or score.isEmpty():
        return score.select("pair", "score")
    own = settle(edges.join(score.select("pair"), "pair", "left_semi").groupBy("h_school", "pair", "h1", "h2").agg(F.max(F.col("m_sim") * F.col("d_sim")).alias("m")), "doubtful-offers")
    offer_count = settle(own.groupBy("h_school").agg(F.count_distinct("h1", "h2").alias("offers")), "doubtful-names")
    before = None
    for _ in range(rounds):
        each = own.join(score.select("pair", "score"), "pair").withColumn("v", F.col("m") * F.col("score"))
        part = F.col("v") / F.sum("v").over(Window.partitionBy("h1", "h2", "h_school"))
        taken = each.withColumn("part", part).groupBy("pair").agg(F.sum("part").alias("part"))
        refined = (F.col("start") + F.col("part") / F.col("offers")) / 2
        score = settle(score.join(taken, "pair").join(offer_count, "h_school").select("h_school", "pair", "start", F.round(refined, 9).alias("score")), "doubtful")
        chosen = score.groupBy("h_school").agg(F.max_by("pair", F.struct("score", "pair")).alias("b"))
        now = tuple(chosen.agg(F.sum(F.xxhash64("h_school", "b").cast("decimal(38,0)")), F.count(F.lit(1))).first())
        if now == before:
            return score.select("pair", "score")
        before = now
    raise RuntimeError(f"the choice of schools hasn't settled in {rounds} rounds")


def choose(edges: DataFrame, scores: DataFrame) -> DataFrame:
    """(p1, p2, h1, h2, confidence): each past offer with the schools of its
    best score and, there, the majors of the best score."""
    past = Window.partitionBy("h1", "h2")
    scored = edges.join(scores, "pair", "left").withColumn("s", F.coalesce("score", (F.col("start") + 1) / 2))
    # a plan offer with an equal major among the same past school's offers
    taken = F.max(F.when(F.col("m_sim") >= 1, 1)).over(Window.partitionBy("p1", "p2", "h_school"))
    scored = scored.withColumn("v", F.col("m_sim") * F.col("d_sim") * F.when((F.col("m_sim") < 1) & taken.isNotNull(), TAKEN).otherwise(1.0))
    near = scored.withColumn("best_s", F.max("s").over(past)).where(F.col("s") >= F.col("best_s") - 1e-9)
    ranked = near.withColumn("stem_v", F.max("v").over(Window.partitionBy("h1", "h2", "p_stem"))).withColumn("best_v", F.max("v").over(past))
    kept = ranked.where((F.col("stem_v") >= F.col("best_v") - 1e-9) | ((F.col("m_sim") >= 1) & (F.col("stem_v") >= OTHER_DIRECTION)))
    confidence = F.round(F.col("s") * F.col("m_sim") * F.col("d_sim"), 4)
    return kept.groupBy("p1", "p2", "h1", "h2").agg(F.max(confidence).alias("confidence"))


def offer_links(plan_rows: DataFrame, history_rows: DataFrame, rename_rows: DataFrame, *, plan_id: str = "src_row_idx", past_id: str = "hist_pos", prune: float = PRUNE, rounds: int = ROUNDS, wordings: Sequence[tuple[str, str]] = SHORT_WORDINGS, words_limit: int = LITERAL_WORDS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The links between offers and who belongs to them: (p1, p2, h1, h2,
    confidence), (plan_id, p1, p2), (past_id, h1, h2) and the size of every
    offer (side, o1, o2, n). Nothing in it grows with the copies of an offer
    but the two memberships."""
    both = keyed(plan_rows.withColumnRenamed(plan_id, "_p"), "_p", "plan", wordings).withColumn("_h", F.lit(None).cast(history_rows.schema[past_id].dataType))
    past = keyed(history_rows.withColumnRenamed(past_id, "_h"), "_h", "past", wordings).withColumn("_p", F.lit(None).cast(plan_rows.schema[plan_id].dataType))
    rows = settle(offers(settle(both.unionByName(past), "keys"), words_limit), "offers")
    kinds = settle(rows.groupBy("side", *OFFER, "o1", "o2").agg(F.count(F.lit(1)).alias("n")), "kinds")
    renamed = settle(renames(rename_rows), "renames")
    schools = settle(school_edges(kinds, renamed, prune), "schools")
    majors = settle(major_edges(kinds, wordings, prune), "majors")
    edges = settle(candidates(kinds, schools, majors), "candidates")
    links = settle(choose(edges, propagate(edges, rounds)), "links")
    members = lambda side, c, i, a, b: rows.where(F.col("side") == side).select(F.col(c).alias(i), F.col("o1").alias(a), F.col("o2").alias(b))
    return links, members("plan", "_p", plan_id, "p1", "p2"), members("past", "_h", past_id, "h1", "h2"), kinds.select("side", "o1", "o2", "n")


def link(plan_rows: DataFrame, history_rows: DataFrame, rename_rows: DataFrame, *, plan_id: str = "src_row_idx", past_id: str = "hist_pos", **options) -> DataFrame:
    """(plan_id, past_id, confidence): all copies of every linked pair.

    Rows without a school or a major link to nothing; a missing category is the
    default category; an empty side gives no rows. Repeated rows are all linked.
    Extra columns are ignored. Only confirmed renames (``is_rename`` true)
    count. Options are those of ``offer_links``.
    """
    links, plan, past, sizes = offer_links(plan_rows, history_rows, rename_rows, plan_id=plan_id, past_id=past_id, **options)
    size = lambda side, a, b: sizes.where(F.col("side") == side).select(F.col("o1").alias(a), F.col("o2").alias(b), F.col("n").alias("_n"))
    one = salted_join(plan, links, ["p1", "p2"], "inner", plan_id, sizes=size("plan", "p1", "p2"))
    both = salted_join(one, past, ["h1", "h2"], "inner", plan_id, sizes=size("past", "h1", "h2"))
    return both.select(plan_id, past_id, "confidence")
