"""Benchmark decontamination with a distributed positional inverted index.

The index holds a posting (document, position) for every occurrence of a benchmark term
in the corpus. For each window of benchmark words the postings of its two rarest terms,
shifted by their offsets in the item, are intersected; what agrees names a document, an
item and how they align, and the words there are then compared one by one. Everything is
DataFrame operations; benchmark-sized tables are broadcast only where Spark measures them small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.llm.common import numbered, stored, with_row_id

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def terms(text: Column) -> Column:
    """Words at positions 1 ... n, an empty string before and after them; NULL text has no words."""
    padded = F.concat(F.lit(" "), F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(" "))
    return F.split(padded, _BETWEEN)


def build_index(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Stored postings (rid, doc_id, pos, tid) of the vocabulary's terms in ``docs`` (rid, doc_id, text).

    ``vocabulary`` (term, tid) has each term once and the empty one, whose posting past
    position 0 tells the length of each document.
    """
    words = docs.select("rid", "doc_id", F.posexplode(terms(F.col("text"))).alias("pos", "term"))
    return stored(words.join(vocabulary, "term").select("rid", "doc_id", "pos", "tid"), "postings")


def vocabulary_of(phrases: DataFrame) -> DataFrame:
    """(term, tid) of the terms in ``phrases`` (words: array) and the empty term."""
    spark = phrases.sparkSession
    found = phrases.select(F.explode("words").alias("term")).where("term IS NOT NULL")
    every = stored(found.union(spark.createDataFrame([("",)], "term string")).distinct(), "vocabulary")
    return with_row_id(every, "tid")


def alignments(index: DataFrame, phrases: DataFrame, vocabulary: DataFrame, window: int) -> DataFrame:
    """(rid, cid, shift): phrase ``cid`` may have a window in ``rid`` with word q at position q + shift.

    A window whose terms do not all occur in the corpus is dropped. Windows share anchors
    where they can: of terms equally rare the one at a multiple of ``window`` goes first.
    """
    df = index.groupBy("tid").agg(F.count("*").alias("df"))
    n = F.size("words")
    width = F.least(F.lit(window), n)
    spots = (phrases.where(n > 0).select("cid", n.alias("n"), width.alias("width"), F.posexplode("words").alias("q", "term"))
             .withColumn("q", F.col("q") + 1).join(vocabulary, "term").join(df, "tid", "left"))
    starts = F.sequence(F.greatest(F.lit(1), F.col("q") - F.col("width") + 1), F.least(F.col("q"), F.col("n") - F.col("width") + 1))
    rare = F.sort_array(F.collect_list(F.struct("df", (F.col("q") % window).alias("turn"), "q", "tid")))
    anchors = (spots.select("cid", "q", "tid", "df", F.explode(starts).alias("s"))
               .groupBy("cid", "s").agg(F.min(F.coalesce("df", F.lit(0))).alias("least"), rare.alias("r"))
               .where("least > 0")
               .select("cid", F.col("r")[0]["tid"].alias("tid1"), F.col("r")[0]["q"].alias("q1"),
                       F.get("r", F.lit(1))["tid"].alias("tid2"), F.get("r", F.lit(1))["q"].alias("q2")).distinct())
    anchors = stored(anchors, "anchors")
    at = lambda t, q: (index.join(anchors.withColumn("tid", F.col(t)), "tid")
                       .select("cid", "q1", "q2", "rid", (F.col("pos") - F.col(q)).alias("shift")))
    first = at("tid1", "q1")
    both = first.join(at("tid2", "q2"), ["cid", "q1", "q2", "rid", "shift"])
    return first.where("q2 IS NULL").union(both).select("rid", "cid", "shift").distinct()


def phrase_matches(docs: DataFrame, index: DataFrame, phrases: DataFrame, vocabulary: DataFrame, window: int) -> DataFrame:
    """(rid, cid, pos, width): every place where a window of a phrase stands word for word.

    ``phrases``: (cid, words); a window is ``window`` consecutive words, or all of a shorter phrase.
    """
    near = stored(alignments(index, phrases, vocabulary, window)
                  .join(phrases.select("cid", F.size("words").alias("n")), "cid"), "alignments")
    by_doc = near.groupBy("rid").agg(F.collect_list(F.struct("cid", "shift", "n")).alias("near"))
    # the stretch of the document under each phrase, so that long documents are not copied for each
    stretch = lambda x: F.struct(
        x["cid"].alias("cid"), x["shift"].alias("shift"), F.greatest(F.lit(1), 1 - x["shift"]).alias("q"),
        F.slice("w", F.greatest(F.lit(1), x["shift"] + 1) + 1, F.greatest(F.lit(0), F.least(x["n"], x["n"] + x["shift"]))).alias("here"))
    found = (docs.join(by_doc, "rid").select("rid", "near", terms(F.col("text")).alias("w"))
             .select("rid", F.inline(F.transform("near", stretch))))
    width = F.least(F.lit(window), F.size("words"))
    same = lambda s: F.slice("here", s - F.col("q") + 1, width) == F.slice("words", s, width)
    last = F.least(F.size("words"), F.col("q") + F.size("here") - 1) - width + 1
    tried = F.when(last >= F.col("q"), F.sequence(F.col("q"), last)).otherwise(F.array().cast("array<int>"))
    return (found.join(phrases, "cid").select("rid", "cid", "shift", width.alias("width"), F.explode(F.filter(tried, same)).alias("s"))
            .select("rid", "cid", (F.col("s") + F.col("shift")).alias("pos"), "width"))


def proximity_matches(index: DataFrame, phrases: DataFrame, vocabulary: DataFrame, slop: int) -> DataFrame:
    """(rid, cid, pos): the rarest term of a phrase is at ``pos`` and all its other terms within ``slop`` words of it.

    Postings meet in buckets of ``slop`` + 1 positions, never document against document.
    """
    df = index.groupBy("tid").agg(F.count("*").alias("df"))
    need = (phrases.select("cid", F.explode(F.array_distinct("words")).alias("term")).join(vocabulary, "term")
            .join(df, "tid", "left").withColumn("df", F.coalesce("df", F.lit(0))))
    plan = need.groupBy("cid").agg(F.min(F.struct("df", "tid")).alias("a"), F.count("*").alias("need")).where("a.df > 0")
    plan = stored(plan.select("cid", F.col("a.tid").alias("anchor"), "need"), "anchors")
    wide = slop + 1
    bucket = F.floor(F.col("pos") / wide)
    anchors = (index.join(plan.withColumn("tid", F.col("anchor")), "tid").select("cid", "need", "rid", F.col("pos").alias("at"))
               .withColumn("bucket", F.explode(F.array(*[F.floor(F.col("at") / wide) + k for k in (-1, 0, 1)]))))
    others = index.join(need.select("cid", "tid"), "tid").select("cid", "rid", "pos", "tid", bucket.alias("bucket"))
    return (anchors.join(others, ["cid", "rid", "bucket"]).where(F.abs(F.col("pos") - F.col("at")) <= slop)
            .groupBy("rid", "cid", "at", "need").agg(F.count_distinct("tid").alias("n")).where("n = need")
            .select("rid", "cid", F.col("at").alias("pos")))


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """For ``docs`` (rid, doc_id, text): rid, doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    items = numbered(benchmark.select("item_id", "text"), "iid")
    items = stored(items.select("iid", "item_id", F.filter(terms(F.col("text")), lambda x: x != "").alias("words")), "items")
    phrases = stored(items.where(F.size("words") > 0).groupBy("words").agg(F.min("iid").alias("cid")), "phrases")
    named = (items.join(phrases, "words").where("item_id IS NOT NULL")
             .select("cid", F.col("item_id").cast("string").alias("item")).distinct())

    vocabulary = vocabulary_of(phrases)
    index = build_index(docs, vocabulary)
    hits = stored(phrase_matches(docs.select("rid", "text"), index, phrases, vocabulary, window), "hits")

    spans = F.sort_array(F.collect_set(F.struct(F.col("pos").alias("a"), (F.col("pos") + F.col("width")).alias("b"))))
    covered = F.aggregate("spans", F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")), lambda acc, x: F.struct(
        (acc["n"] + F.greatest(F.lit(0), x["b"] - F.greatest(x["a"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], x["b"]).alias("end")))["n"]
    n_hit = hits.groupBy("rid").agg(spans.alias("spans")).select("rid", covered.cast("bigint").alias("n_hit"))
    which = (hits.select("rid", "cid").distinct().join(named, "cid").groupBy("rid")
             .agg(F.sort_array(F.collect_set("item")).alias("items")))
    length = index.join(vocabulary.where("term = ''"), "tid").where("pos > 0")
    return (length.select("rid", "doc_id", (F.col("pos") - 1).cast("bigint").alias("n_words"))
            .join(n_hit, "rid", "left").join(which, "rid", "left")
            .select("rid", "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
                    F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
                    F.col("n_hit").isNotNull().alias("contaminated")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text",
                  id_col: str = "doc_id") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated for each row.

    A benchmark without words, or none, contaminates nothing. Repeated items count once by
    item_id; a NULL item_id's text still hits but is not listed. Repeated documents and NULL
    ids keep their rows; other columns are not read; an empty table gives no rows.
    """
    d = with_row_id(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return report(d, benchmark, window).drop("rid")


def oracle() -> str:
    """DuckDB SQL for ``decontaminate`` over documents and benchmark."""
    words = (rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
             r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
b AS (SELECT item_id, {words} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(10, len(w)) AS n, list_slice(w, s, s + least(10, len(w)) - 1) AS win
         FROM (SELECT item_id, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS s FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM wins),
dw AS (SELECT rid, n, p, list_slice(w, p, p + n - 1) AS win
       FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.rid, wins.item_id, dw.p, dw.n FROM dw JOIN wins ON dw.n = wins.n AND dw.win = wins.win),
pos AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS place FROM hit) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT rid, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(pos.n_hit, 0)::BIGINT AS n_hit,
       coalesce(its.n_items, 0)::BIGINT AS n_items, sha256(coalesce(its.items, '')) AS items_sha256,
       pos.n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN pos ON d.rid = pos.rid LEFT JOIN its ON d.rid = its.rid"""
