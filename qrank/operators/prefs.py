"""Preference-judgment measures without materialising document pairs.

A judge group (jg) with one sub-group prefers every document of a higher
level to every document of a lower level.  For a ranking, each preference
(winner a, loser b) falls in one of five areas: both retrieved and a ranked
first (fulfilled), both retrieved and b first, only a retrieved (implied,
fulfilled), only b retrieved, neither retrieved.  All five counts follow
from per-level document counts (retrieved / not retrieved) and one window
over the retrieved judged documents in rank order holding running counts
per level - never from the quadratic set of pairs.

The ``_Rnonrel`` variants (non-relevant documents capped at the number of
relevant ones) reuse the same pass: the capped class is the first R
documents of the lowest level in compact order.

A judge group with several sub-groups prefers what a chain of sub-groups
prefers.  Its documents are counted by class (see :mod:`prefclosure`): the
closure is a relation of classes, and the ordered counts of two classes are
taken block by block of the ranking.

``prefs_pair*`` (vote share per document pair across judge groups) group
documents by their classes in all judge groups: a pair's votes depend only on
the two classes, for any number of them (``pair_measures``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.tables import shuffled, written
from . import prefclosure as C
from .judge import EvalOptions
from .ranking import running

# Up to this many distinct levels, one running count per level; beyond it, one
# per binary digit of the level's number (same counts, more passes).
MAX_LEVELS = 64

PREFS_MEASURES = ["prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret", "prefs_simp",
                  "prefs_pair", "prefs_avgjg", "prefs_avgjg_Rnonrel", "prefs_simp_ret", "prefs_pair_ret",
                  "prefs_avgjg_ret", "prefs_avgjg_Rnonrel_ret", "prefs_simp_imp", "prefs_pair_imp",
                  "prefs_avgjg_imp"]
SUMMED = {"prefs_num_prefs_poss", "prefs_num_prefs_ful", "prefs_num_prefs_ful_ret"}
PAIR = {"prefs_pair", "prefs_pair_ret", "prefs_pair_imp"}


def higher_before(docs: DataFrame, keys: list[str], order: list[Column], extra: dict[str, Column],
                  prefs: DataFrame, skew_safe: bool) -> DataFrame:
    """``docs`` with ``_hi``, the retrieved docs (``_ret`` = 1) of a higher level that come
    before a doc in ``order``, and the running sums ``extra``, for any number of levels.

    Levels are numbered in order.  Two levels differ first at some binary
    digit, above which their numbers agree; there the higher one has 1 and the
    lower one 0.  So per digit, docs with 0 count the earlier retrieved docs
    with 1 among those that agree above it.
    """
    from ..plans.sizing import sequential_index

    levels = written(prefs.select("rel_level").distinct().orderBy("rel_level").withColumn("_o", F.monotonically_increasing_id()), "levels")
    bits = max(1, int(levels.count()).bit_length())
    docs = docs.join(sequential_index(levels, "_o", "_lid").select("rel_level", "_lid"), "rel_level")
    out = running(docs, keys, order, extra, skew_safe=skew_safe, rank_col=None).withColumn("_hi", F.lit(0).cast("long"))
    for b in range(bits):
        one = F.shiftright("_lid", b).bitwiseAND(1)
        out = running(out.withColumn("_px", F.shiftright("_lid", b + 1)), keys + ["_px"], order, {"_ones": one * F.col("_ret")},
                      skew_safe=skew_safe, rank_col=None)
        out = out.withColumn("_hi", F.col("_hi") + F.when(one == 0, F.col("_ones")).otherwise(0)).drop("_px", "_ones")
    return out.drop("_lid")


COUNTS = ["ful_ret", "poss_ret", "ful_imp", "poss_imp", "notoccur", "num_rel", "num_rel_ret", "num_nonrel", "num_nonrel_ret",
          "rn_ful", "rn_poss", "rn_ful_ret", "rn_poss_ret"]


def prefs_counts(run: DataFrame, prefs: DataFrame, skew_safe: bool | None = None) -> DataFrame:
    """Per (run_id, qid, jg): ful_ret, poss_ret, ful_imp, poss_imp, notoccur,
    num_rel, num_rel_ret, num_nonrel, num_nonrel_ret.

    A judge group of a topic with one sub-group is counted by levels, one with
    several by classes of the closed relation.  Equal rows count once.  A
    document at two levels of one sub-group ends the job; with several
    sub-groups so does one at 0 and above 0, and a contradiction.
    """
    if skew_safe is None:
        from .ranking import decide
        skew_safe, run = decide(run, ["run_id", "qid"], None)
    prefs = prefs.select("qid", "jg", "jsg", "docno", "rel_level").distinct()
    kinds = written(prefs.groupBy("qid", "jg").agg((F.countDistinct("jsg") > 1).alias("several")), "judge-groups")
    found = {r.several for r in kinds.select("several").distinct().collect()}
    if found != {True, False}:
        return (_closed_counts if True in found else _level_counts)(run, prefs, prefs, skew_safe)
    part = lambda several: prefs.join(kinds.where(F.col("several") == several).select("qid", "jg"), ["qid", "jg"], "left_semi")
    return _level_counts(run, part(False), prefs, skew_safe).unionByName(_closed_counts(run, part(True), prefs, skew_safe))


def judged_ranks(run: DataFrame, prefs: DataFrame, skew_safe: bool) -> DataFrame:
    """(run_id, qid, docno, rank): the retrieved documents that any group of the topic judges, in order."""
    judged = prefs.select("qid", "docno").distinct()
    r = run.select("run_id", "qid", "docno", "sim").join(judged, ["qid", "docno"], "left_semi")
    return running(r, ["run_id", "qid"], [F.desc("sim"), F.asc("docno")], {}, skew_safe=skew_safe).drop("sim")


def _closed_counts(run: DataFrame, prefs: DataFrame, all_prefs: DataFrame, skew_safe: bool) -> DataFrame:
    """:func:`prefs_counts` of judge groups with any number of sub-groups, by classes."""
    group, keys = C.GROUP, ["run_id", *C.GROUP]
    classes = shuffled(written(C.document_classes(prefs), "classes"))
    pairs = shuffled(written(C.preferred(C.class_levels(classes)), "class-pairs"))
    topics = run.select("run_id", "qid").distinct().join(prefs.select("qid").distinct(), "qid")
    members = classes.select(*group, "docno", "cls", "level").join(
        classes.groupBy(*group).agg(F.count_if(F.col("level") > 0).alias("num_rel"), F.count_if(F.col("level") == 0).alias("num_nonrel")), group)
    docs = topics.join(members, "qid").join(judged_ranks(run, all_prefs, skew_safe), ["run_id", "qid", "docno"], "left")
    ret, zero = F.col("rank").isNotNull(), F.col("level") == 0
    # the recount leaves out documents at level 0 behind the first num_rel of them
    docs = running(docs, keys, [F.desc(ret), F.asc("rank"), F.asc("docno")], {"_zeros": zero.cast("long")}, skew_safe=skew_safe, rank_col=None)
    docs = shuffled(written(docs.withColumn("kept", ~zero | (F.col("_zeros") <= F.col("num_rel"))), "judged"))
    own = docs.groupBy(*keys, "cls", "kept").agg(F.count(F.lit(1)).alias("n"), F.count_if(ret).alias("r"))
    order = C.ordered_pairs(docs.where(ret), keys, ["cls", "kept"], F.col("rank"))
    order = order.select(*keys, F.col("u.cls").alias("u"), F.col("u.kept").alias("ku"), F.col("v.cls").alias("v"),
                         F.col("v.kept").alias("kv"), "pr")
    side = lambda x: own.select(*keys, F.col("cls").alias(x), F.col("kept").alias("k" + x), F.col("n").alias("n" + x),
                                F.col("r").alias("r" + x))
    both = (side("u").join(pairs, [*group, "u"]).join(side("v"), [*keys, "v"]).join(order, [*keys, "u", "ku", "v", "kv"], "left"))
    nu, ru, nv, rv, pr = F.col("nu"), F.col("ru"), F.col("nv"), F.col("rv"), F.coalesce("pr", F.lit(0))
    kept = F.col("ku") & F.col("kv")
    total = lambda e, name: F.sum(e).alias(name)
    when = lambda e: F.when(kept, e).otherwise(0)
    counted = both.groupBy(*keys).agg(
        total(pr, "ful_ret"), total(ru * rv, "poss_ret"), total(ru * (nv - rv), "ful_imp"),
        total(ru * (nv - rv) + (nu - ru) * rv, "poss_imp"), total((nu - ru) * (nv - rv), "notoccur"),
        total(when(pr + ru * (nv - rv)), "rn_ful"), total(when(nu * nv), "rn_poss"),
        total(when(pr), "rn_ful_ret"), total(when(ru * rv), "rn_poss_ret"))
    nums = docs.groupBy(*keys).agg(F.max("num_rel").alias("num_rel"), F.count_if(ret & (F.col("level") > 0)).alias("num_rel_ret"),
                                   F.max("num_nonrel").alias("num_nonrel"), F.count_if(ret & zero).alias("num_nonrel_ret"))
    return nums.join(counted, keys, "left").select(*keys, *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in COUNTS))


def _level_counts(run: DataFrame, prefs: DataFrame, all_prefs: DataFrame, skew_safe: bool) -> DataFrame:
    """:func:`prefs_counts` of judge groups with one sub-group, by levels."""
    levels = [r.rel_level for r in prefs.select("rel_level").distinct().limit(MAX_LEVELS + 1).collect()]
    many, levels = len(levels) > MAX_LEVELS, sorted(levels)
    p = prefs.groupBy("qid", "jg", "docno").agg(F.min("rel_level").alias("rel_level"), F.max("rel_level").alias("_high"))
    two = F.raise_error(F.concat(F.lit("document "), "docno", F.lit(" of topic "), "qid", F.lit(", judge group "), "jg",
                                 F.lit(" has two levels in one sub-group"))).cast("double")
    p = p.select("qid", "jg", "docno", F.when(F.col("rel_level") < F.col("_high"), two).otherwise(F.col("rel_level")).alias("rel_level"))
    # Retrieved judged docs of each run and topic (judged = in any group of the topic).
    r = judged_ranks(run, all_prefs, skew_safe)
    topics = run.select("run_id", "qid").distinct().join(p.select("qid").distinct(), "qid")
    last_level = p.groupBy("qid", "jg").agg(F.min("rel_level").alias("_min_level"))
    # Every judged doc of the run's topics, with its rank if retrieved.
    docs = (topics.join(p, "qid").join(r, ["run_id", "qid", "docno"], "left")
                  .join(last_level, ["qid", "jg"]))
    ret = F.col("rank").isNotNull()
    lvl = F.col("rel_level")
    docs = docs.withColumn("_ret", ret.cast("long")).withColumn("_last", (lvl == F.col("_min_level")).cast("long"))
    keys = ["run_id", "qid", "jg"]

    # One pass over each group's judged docs in compact order (retrieved docs
    # by rank, then the others by docno) with running counts of retrieved
    # docs per level: every doc learns how many retrieved docs of a higher
    # level precede it (fulfilled preferences won by those docs).
    order = [F.desc("_ret"), F.asc("rank"), F.asc("docno")]
    sums = {"_rb": F.col("_ret"), "_pl": F.col("_last")}
    if many:
        cd = higher_before(docs, keys, order, sums, p, skew_safe)
    else:
        sums.update({f"_c{i}": ((lvl == lv) & ret).cast("long") for i, lv in enumerate(levels)})
        cd = running(docs, keys, order, sums, skew_safe=skew_safe, rank_col=None)
        cd = cd.withColumn("_hi", sum((F.when(lvl < lv, F.col(f"_c{i}")).otherwise(0) for i, lv in enumerate(levels)), F.lit(0)))
    cd = cd.withColumn("_ret_before", F.col("_rb") - F.col("_ret"))

    # Level histograms split by retrieval -> pair totals.
    hist = docs.groupBy(*keys, "rel_level", "_min_level").agg(F.count_if(ret).alias("r"), F.count_if(~ret).alias("u"))
    nl = lvl != F.col("_min_level")
    tot = hist.groupBy(*keys).agg(
        F.sum("r").alias("R"), F.sum("u").alias("U"),
        F.sum(F.col("r") * F.col("r")).alias("RR"), F.sum(F.col("u") * F.col("u")).alias("UU"),
        F.sum(F.col("r") * F.col("u")).alias("RU"),
        F.sum(F.when(nl, F.col("r") + F.col("u")).otherwise(0)).alias("T1"),
        F.sum(F.when(nl, (F.col("r") + F.col("u")) * (F.col("r") + F.col("u"))).otherwise(0)).alias("S1"),
        F.sum(F.when(nl, F.col("r")).otherwise(0)).alias("T1r"),
        F.sum(F.when(nl, F.col("r") * F.col("r")).otherwise(0)).alias("S1r"),
        F.sum(F.when(lvl > 0, F.col("r") + F.col("u")).otherwise(0)).alias("num_rel"),
        F.sum(F.when(lvl > 0, F.col("r")).otherwise(0)).alias("num_rel_ret"),
        F.sum(F.when(lvl <= 0, F.col("r") + F.col("u")).otherwise(0)).alias("num_nonrel"),
        F.sum(F.when(lvl <= 0, F.col("r")).otherwise(0)).alias("num_nonrel_ret"))
    # Per-doc sums; the recount of the non-relevant tail needs the group's R.
    cdt = cd.join(tot.select(*keys, "num_rel", "num_rel_ret"), keys)
    last = F.col("_last") == 1
    y_all = last & (F.col("_pl") <= F.col("num_rel"))
    y_ret = last & ret & (F.col("_pl") <= F.col("num_rel_ret"))
    per = cdt.groupBy(*keys).agg(
        F.sum(F.when(ret, F.col("_hi")).otherwise(0)).alias("ful_ret"),
        F.sum(F.when(~ret, F.col("_hi")).otherwise(0)).alias("ful_imp"),
        F.sum(F.when(~last, F.col("_hi")).otherwise(0)).alias("rn_ful1"),
        F.sum(F.when(~last & ret, F.col("_hi")).otherwise(0)).alias("rn_ful1r"),
        F.sum(F.when(y_all, F.col("_ret_before")).otherwise(0)).alias("rn_ful2"),
        F.sum(F.when(y_ret, F.col("_ret_before")).otherwise(0)).alias("rn_ful2r"),
        F.count_if(y_all).alias("rn_y"), F.count_if(y_ret).alias("rn_yr"))
    out = tot.join(per, keys, "left")
    n_tot = F.col("R") + F.col("U")
    return out.select(
        *keys,
        F.coalesce("ful_ret", F.lit(0)).cast("long").alias("ful_ret"),
        ((F.col("R") * F.col("R") - F.col("RR")) / 2).cast("long").alias("poss_ret"),
        F.coalesce("ful_imp", F.lit(0)).cast("long").alias("ful_imp"),
        (F.col("R") * F.col("U") - F.col("RU")).cast("long").alias("poss_imp"),
        ((F.col("U") * F.col("U") - F.col("UU")) / 2).cast("long").alias("notoccur"),
        F.col("num_rel").cast("long"), F.col("num_rel_ret").cast("long"),
        F.col("num_nonrel").cast("long"), F.col("num_nonrel_ret").cast("long"),
        # recount with only the first R non-relevant docs (see rnonrel_value)
        (F.coalesce("rn_ful1", F.lit(0)) + F.coalesce("rn_ful2", F.lit(0))).cast("long").alias("rn_ful"),
        (((F.col("T1") * F.col("T1") - F.col("S1")) / 2) + n_tot * F.coalesce("rn_y", F.lit(0))).cast("long").alias("rn_poss"),
        (F.coalesce("rn_ful1r", F.lit(0)) + F.coalesce("rn_ful2r", F.lit(0))).cast("long").alias("rn_ful_ret"),
        (((F.col("T1r") * F.col("T1r") - F.col("S1r")) / 2) + F.col("R") * F.coalesce("rn_yr", F.lit(0))).cast("long").alias("rn_poss_ret"))


def rnonrel_value(ret_only: bool) -> tuple[Column, Column]:
    """(fulfilled, possible) of one judge group with non-relevant docs
    capped at the number of relevant ones.

    When there are at least as many relevant as non-relevant docs, the
    plain counts get (R - N) extra wins per relevant retrieved doc;
    otherwise the recount keeps the first R docs of the lowest class
    (pairs with every doc of the group, that class included).
    """
    c = F.col
    if ret_only:
        R, N = c("num_rel_ret"), c("num_nonrel_ret")
        ful = F.when(R >= N, c("ful_ret") + c("num_rel_ret") * (R - N)).otherwise(c("rn_ful_ret"))
        poss = F.when(R >= N, c("poss_ret") + c("num_rel") * (R - N)).otherwise(c("rn_poss_ret"))
    else:
        R, N = c("num_rel"), c("num_nonrel")
        ful = F.when(R >= N, c("ful_ret") + c("ful_imp") + c("num_rel_ret") * (R - N)).otherwise(c("rn_ful"))
        poss = F.when(R >= N, c("poss_ret") + c("poss_imp") + c("notoccur") + c("num_rel") * (R - N)) \
                .otherwise(c("rn_poss"))
    return ful, poss


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def evaluate_prefs(run: DataFrame, prefs: DataFrame, measures=PREFS_MEASURES,
                   opts: EvalOptions = EvalOptions(), per_topic: bool = True, summary: bool = True) -> DataFrame:
    """Long table (run_id, qid, measure, value) of preference measures."""
    from .measures import stack_long
    from .summary import summarize

    if opts.skew_safe is None:
        from dataclasses import replace
        from .ranking import decide
        flag, run = decide(run, ["run_id", "qid"], None)
        opts = replace(opts, skew_safe=flag)
    c = prefs_counts(run, prefs, opts.skew_safe)
    rn_ful, rn_poss = rnonrel_value(False)
    rr_ful, rr_poss = rnonrel_value(True)
    poss_all = F.col("poss_ret") + F.col("poss_imp") + F.col("notoccur")
    ful_all = F.col("ful_ret") + F.col("ful_imp")
    per = c.groupBy("run_id", "qid").agg(
        F.count(F.lit(1)).alias("n_jg"),
        F.sum(poss_all).alias("poss"), F.sum(ful_all).alias("ful"), F.sum("ful_ret").alias("fr"),
        F.sum("poss_ret").alias("pr"), F.sum(F.col("poss_ret") + F.col("poss_imp")).alias("pi"),
        F.sum(_ratio(ful_all, poss_all)).alias("avg_all"),
        F.sum(_ratio(F.col("ful_ret"), F.col("poss_ret"))).alias("avg_ret"),
        F.sum(_ratio(ful_all, F.col("poss_ret") + F.col("poss_imp"))).alias("avg_imp"),
        # a group with nothing possible makes the whole topic 0 (0/0 in the sum)
        F.sum(F.when(rn_poss > 0, rn_ful / rn_poss)).alias("avg_rn"), F.count_if(rn_poss <= 0).alias("rn_bad"),
        F.sum(F.when(rr_poss > 0, rr_ful / rr_poss)).alias("avg_rr"), F.count_if(rr_poss <= 0).alias("rr_bad"))
    if any(m in PAIR for m in measures):
        per = per.join(pair_measures(run, prefs, opts.skew_safe), ["run_id", "qid"], "left")
    avg = lambda s: F.when(F.col(s) > 0, F.col(s) / F.col("n_jg")).otherwise(F.lit(0.0))
    exprs = {
        "prefs_num_prefs_poss": F.col("poss").cast("double"),
        "prefs_num_prefs_ful": F.col("ful").cast("double"),
        "prefs_num_prefs_ful_ret": F.col("fr").cast("double"),
        "prefs_simp": _ratio(F.col("ful"), F.col("poss")),
        "prefs_pair": F.coalesce(F.col("prefs_pair"), F.lit(0.0)) if "prefs_pair" in measures else F.lit(0.0),
        "prefs_avgjg": avg("avg_all"),
        "prefs_simp_ret": _ratio(F.col("fr"), F.col("pr")),
        "prefs_pair_ret": F.coalesce(F.col("prefs_pair_ret"), F.lit(0.0)) if "prefs_pair_ret" in measures else F.lit(0.0),
        "prefs_avgjg_ret": avg("avg_ret"),
        "prefs_simp_imp": _ratio(F.col("ful"), F.col("pi")),
        "prefs_pair_imp": F.coalesce(F.col("prefs_pair_imp"), F.lit(0.0)) if "prefs_pair_imp" in measures else F.lit(0.0),
        "prefs_avgjg_imp": avg("avg_imp"),
        "prefs_avgjg_Rnonrel": F.when(F.col("rn_bad") > 0, F.lit(0.0)).otherwise(avg("avg_rn")),
        "prefs_avgjg_Rnonrel_ret": F.when(F.col("rr_bad") > 0, F.lit(0.0)).otherwise(avg("avg_rr")),
    }
    wide = per.select("run_id", "qid", *[exprs[m].alias(m) for m in measures])
    long = stack_long(wide, list(measures))
    kinds = {m: ("sum" if m in SUMMED else "avg") for m in measures}
    parts = []
    if per_topic:
        parts.append(long)
    if summary:
        q = prefs.select("qid", F.lit(1).alias("rel"))
        parts.append(summarize(long, kinds, q, opts))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


# ------------------------------------------------- pair votes across judges

def class_votes(prefs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes, votes) across the judge groups of each topic.

    classes: (qid, docno, c), c numbers the documents' classes in all judge
    groups together.  votes: (qid, u, v, f, g) with u < v and f + g > 0, the
    number of judge groups that prefer u to v, and v to u.
    """
    prefs = prefs.select("qid", "jg", "jsg", "docno", "rel_level").distinct()
    own = written(C.document_classes(prefs), "classes")
    levels = C.class_levels(own)
    several = not levels.groupBy(*C.GROUP).agg(F.countDistinct("jsg").alias("n")).where("n > 1").isEmpty()
    pairs = C.preferred(levels, several)
    docs = own.groupBy("qid", "docno").agg(F.array_sort(F.collect_list(F.struct("jg", "cls"))).alias("all"))
    docs = written(C.numbered(docs, ["qid"], "all", "c"), "vote-classes")
    parts = docs.select("qid", "c", "all").distinct().select("qid", "c", F.explode("all").alias("x")).select("qid", "c", "x.jg", "x.cls")
    part = lambda x, c: parts.select(*C.GROUP, F.col("cls").alias(x), F.col("c").alias(c))
    # each judge group tells every pair of its classes once, in one direction: a vote for u, or for v
    voted = pairs.join(part("u", "a"), [*C.GROUP, "u"]).join(part("v", "b"), [*C.GROUP, "v"])
    votes = voted.groupBy("qid", F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).agg(
        F.count_if(F.col("a") < F.col("b")).alias("f"), F.count_if(F.col("a") > F.col("b")).alias("g"))
    return docs.select("qid", "docno", "c"), votes


def pair_measures(run: DataFrame, prefs: DataFrame, skew_safe: bool | None = None) -> DataFrame:
    """Per (run_id, qid): prefs_pair, prefs_pair_ret, prefs_pair_imp over
    any number of judge groups, sub-groups and judgment vectors.

    For an unordered pair of judged docs with votes, the better-placed doc
    (retrieved docs in rank order, then the rest by docno) scores the share
    of votes preferring it.  Votes and sizes are those of the two classes,
    and so is the number of pairs in which the one class comes first.
    """
    from .ranking import decide
    if skew_safe is None:
        skew_safe, run = decide(run, ["run_id", "qid"], None)
    classes, votes = class_votes(prefs)
    keys = ["run_id", "qid"]
    topics = run.select(*keys).distinct().join(prefs.select("qid").distinct(), "qid")
    docs = written(topics.join(classes, "qid").join(judged_ranks(run, prefs, skew_safe), [*keys, "docno"], "left"), "judged")
    ret = F.col("rank").isNotNull()
    cnt = docs.groupBy(*keys, "c").agg(F.count(F.lit(1)).alias("n"), F.count_if(ret).alias("r"))
    side = lambda x: cnt.select(*keys, F.col("c").alias(x), F.col("n").alias("n" + x), F.col("r").alias("r" + x))
    # of two classes only the one direction: in the other stand the remaining pairs
    order = C.ordered_pairs(docs.where(ret), keys, ["c"], F.col("rank"), F.expr("u.c < v.c")).select(
        *keys, F.col("u.c").alias("u"), F.col("v.c").alias("v"), "pr")
    pairs = side("u").join(votes, ["qid", "u"]).join(side("v"), [*keys, "v"]).join(order, [*keys, "u", "v"], "left")
    nu, ru, nv, rv, pr = F.col("nu"), F.col("ru"), F.col("nv"), F.col("rv"), F.coalesce("pr", F.lit(0))
    wu = F.col("f") / (F.col("f") + F.col("g"))
    wv = F.col("g") / (F.col("f") + F.col("g"))
    both = wu * pr + wv * (ru * rv - pr)
    agg = pairs.groupBy(*keys).agg(
        F.sum(both + wu * ru * (nv - rv) + wv * rv * (nu - ru)).alias("s_all"), F.sum(both).alias("s_ret"),
        F.sum(nu * nv).alias("n_all"), F.sum(ru * rv).alias("n_ret"), F.sum(nu * nv - (nu - ru) * (nv - rv)).alias("n_imp"))
    return (topics.select(*keys).join(agg, keys, "left")
                  .select(*keys, _ratio(F.coalesce("s_all", F.lit(0.0)), F.coalesce("n_all", F.lit(0))).alias("prefs_pair"),
                          _ratio(F.coalesce("s_ret", F.lit(0.0)), F.coalesce("n_ret", F.lit(0))).alias("prefs_pair_ret"),
                          _ratio(F.coalesce("s_all", F.lit(0.0)), F.coalesce("n_imp", F.lit(0))).alias("prefs_pair_imp")))
