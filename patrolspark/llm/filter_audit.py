"""Filter interaction audit by the Hart-Mas-Colell potential.

Every document is a mask of the filters it fails.  In the removal game of a part
a coalition S of filters is worth v(S), the documents that fail at least one
filter of S.  The potential is built up over all coalitions,

    |S| P(S) = v(S) + sum of P(S without i) over the members i of S,    P({}) = 0,

and the Shapley value of a filter is P(all) - P(all without it).  With
Q(S) = |S|! P(S) the recursion stays in whole numbers, and n! times the Shapley
value (what the filter removes, summed over all n! orders) is
Q(all) - n Q(all without it).  What a step of an order removes is a difference
of two coalitions: the filters up to and with the step, and those before it.
The same game over the good and over the toxic documents gives what each step
loses of them.

Texts are read once, to (id, part, mask, text hash); these short rows shuffle once
by hash, to find earlier copies, and once by id, to meet their labels.  After
that a part is at most 4 * 2^n counts.
All of it is DataFrame functions.

Defined cases: a null text is empty; a null part is the empty string (and shares
it); rows repeated with one id are each a document, none an earlier copy of the
other; a row with a null id is neither an earlier copy nor has one; a document
labelled more than once is good (toxic) if any row says 1; a null label is not 1;
texts of any length count whole; an empty table gives an empty result; columns
of the caller are only read by name, so clashing names do no harm.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, col, cut

SPLIT = r"[\x20\x09-\x0D]+"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_WORDS = 200
LEAST_DISTINCT = 50
MOST_CAPITALS = 3
FORBIDDEN = "[#$%&*|]"
#: Orders are written out as one array: 7! of them are still small.
MOST_FILTERS = 7
LETTERS = "ABCDEFG"


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D, which read one text alone, that the text fails."""
    def of_words(w: Column) -> Column:
        few = F.when(F.size(w) < LEAST_WORDS, 1).otherwise(0)
        return few + F.when(100 * F.size(F.array_distinct(w)) < LEAST_DISTINCT * F.size(w), 2).otherwise(0)

    words = F.filter(F.split(text, SPLIT), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, CAPITALS, ""))
    # a lambda over one array of words: the text is split once
    return (F.transform(F.array(words), of_words)[0] + F.when(100 * capitals > MOST_CAPITALS * F.length(text), 4).otherwise(0)
            + F.when(text.rlike(FORBIDDEN), 8).otherwise(0))


def masked(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", part: str = "lang") -> DataFrame:
    """(id, part, mask) of every document; bit 4, filter E, is an equal text with a smaller id."""
    body = F.coalesce(col(docs, text), F.lit(""))
    rows = cut(docs.select(
        col(docs, doc_id).cast("long").alias("id"), F.coalesce(col(docs, part), F.lit("")).alias("part"),
        text_mask(body).alias("mask"), F.unhex(F.sha2(body.cast("binary"), 256)).alias("sha")))
    first = rows.groupBy("sha").agg(F.min("id").alias("first"), F.count("id").alias("n")).where("n > 1")
    first = first.select(F.col("sha").alias("f_sha"), apart(F.col("sha")).alias("f_apart"), "first")
    same = (F.col("sha") == F.col("f_sha")) & (apart(F.col("sha")) == F.col("f_apart"))
    later = F.coalesce(F.col("id") > F.col("first"), F.lit(False))
    return rows.join(first, same, "left").select(
        "id", "part", (F.col("mask") + F.when(later, 16).otherwise(0)).alias("mask"))


def counted(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", good: str = "quality",
            toxic: str = "toxic") -> DataFrame:
    """(part, mask, n, good, toxic): documents of each part and mask, and those labelled good and toxic."""
    def one(name: str) -> Column:
        return F.max(F.when(col(labels, name).cast("int") == 1, 1).otherwise(0))

    known = labels.groupBy(col(labels, doc_id).cast("long").alias("l_id")).agg(one(good).alias("good"), one(toxic).alias("toxic"))
    rows = rows.join(known, F.col("id") == F.col("l_id"), "left")
    return rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"))


def coalitions(counts: DataFrame, filters: int) -> DataFrame:
    """One row a part: its size and, at index S, the worth of coalition S in each game."""
    held = counts.select("part", "mask", "n", "good", "toxic", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))).alias("s"))

    def worth(name: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("mask").bitwiseAND(F.col("s")) != 0, F.col(name))), F.lit(0))

    held = held.groupBy("part", "s").agg(
        F.sum("n").alias("docs"), worth("n").alias("all"), worth("good").alias("good"), worth("toxic").alias("toxic"))
    held = held.groupBy("part").agg(  # 2^filters rows a part
        F.max("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("s", "all", "good", "toxic"))).alias("v"))
    return held.select("part", "docs", *[F.col("v")[g].alias(f"v_{g}") for g in ("all", "good", "toxic")])


def potentials(worth: Column, filters: int) -> Column:
    """|S|! P(S) at index S, for the worth of each coalition at the same index."""
    own = F.array(*[F.lit(factorial(max(0, k - 1))).cast("long") for k in range(filters + 1)])

    def grown(q: Column, s: Column) -> Column:
        below = sum((F.when(s.bitwiseAND(F.lit(1 << i)) != 0, F.get(q, s - (1 << i))).otherwise(F.lit(0))
                     for i in range(filters)), F.lit(0))
        return F.array_append(q, F.get(own, F.bit_count(s)) * F.get(worth, s) + below)

    # subsets of S are smaller numbers, so their potentials are there already
    return F.aggregate(F.sequence(F.lit(1), F.lit((1 << filters) - 1)), F.array(F.lit(0).cast("long")), grown)


def audit(counts: DataFrame, filters: int = 5) -> DataFrame:
    """One row per part, order and step, from ``counted`` rows of masks over the filters A, B, ..."""
    if not 1 <= filters <= MOST_FILTERS:
        raise ValueError(f"1 to {MOST_FILTERS} filters")
    names, full = LETTERS[:filters], (1 << filters) - 1
    games = coalitions(counts, filters).withColumn("q", potentials(F.col("v_all"), filters))
    orders = F.array(*[F.lit("".join(p)) for p in permutations(names)])
    rows = games.withColumn("filter_order", F.explode(orders))
    rows = rows.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(filters))))
    bits = F.expr(f"transform(sequence(1, {filters}), k -> shiftleft(1, instr('{names}', substr(filter_order, k, 1)) - 1))")
    rows = rows.withColumn("bits", bits).withColumn("own", F.get("bits", F.col("step") - 1))
    rows = rows.withColumn("before", F.aggregate(F.slice("bits", F.lit(1), F.col("step") - 1), F.lit(0), lambda a, b: a + b))

    def gain(game: str, first: Column, then: Column) -> Column:
        return F.get(F.col(game), then) - F.get(F.col(game), first)

    own, before, everything = F.col("own"), F.col("before"), F.lit(full)
    after, others = before + own, everything - own
    removed = gain("v_all", before, after)
    return rows.select(
        "part", "filter_order", "step", (F.col("docs") - F.get("v_all", after)).alias("kept"), removed.alias("removed"),
        (F.get("v_all", own) - removed).alias("redundant"), gain("v_all", others, everything).alias("unique_fails"),
        gain("v_good", before, after).alias("good_lost"), gain("v_toxic", before, after).alias("toxic_lost"),
        (F.get("q", everything) - filters * F.get("q", others)).alias("shapley"))


ORACLE = r"""
with recursive d as (
  select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w
  from documents),
l as (select doc_id as l_id, max(case when quality = 1 then 1 else 0 end) as good,
             max(case when toxic = 1 then 1 else 0 end) as toxic from labels group by doc_id),
f as (
  select part, coalesce(good, 0) as good, coalesce(toxic, 0) as toxic, [
           len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
           100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
           coalesce(doc_id > min(doc_id) over (partition by t), false)] as fails
  from d left join l on doc_id = l_id),
o as (
  select '' as filter_order union all
  select filter_order || x from o, unnest(['A', 'B', 'C', 'D', 'E']) as u(x)
  where len(filter_order) < 5 and not contains(filter_order, x)),
s as (
  select part, filter_order, step, good, toxic, fails[instr('ABCDE', filter_order[step])] as fail,
         len(list_filter(range(1, 6), lambda k: fails[k])) as n_fails,
         len(list_filter(range(1, step), lambda k: fails[instr('ABCDE', filter_order[k])])) > 0 as gone
  from f, (select filter_order, unnest(range(1, 6)) as step from o where len(filter_order) = 5)),
g as (
  select part, filter_order, cast(step as int) as step, count(*) filter (where not gone and not fail) as kept,
         count(*) filter (where not gone and fail) as removed, count(*) filter (where gone and fail) as redundant,
         count(*) filter (where fail and n_fails = 1) as unique_fails,
         count(*) filter (where not gone and fail and good = 1) as good_lost,
         count(*) filter (where not gone and fail and toxic = 1) as toxic_lost
  from s group by part, filter_order, step)
select *, cast(sum(removed) over (partition by part, filter_order[step]) as bigint) as shapley from g
"""
