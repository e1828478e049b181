"""Benchmark decontamination with a distributed positional inverted index.

Index: every occurrence in the corpus of a word that the benchmark uses is
stored as a posting (document, position, term), written by the tasks that scan
the documents, without a shuffle.  A posting of the empty term at the position
after the last word carries each document's length, so the corpus is read once.

Phrases: a benchmark text's windows of ``WINDOW`` words (the whole text if
shorter).  Term counts come from the index; a phrase with a term that the corpus lacks
is out at once.  For the others the lists of their rarest terms are moved back by the
terms' offsets and intersected by (phrase, document, start); what is left is
checked against the postings of all the phrase's terms in those documents, so
matches are exact.

Proximity: all terms of a phrase within so many words of its rarest term, in any order.

Only DataFrame functions are used.  Which side of a join is broadcast is left
to the planner, by the size of the tables written before.

Defined results: words are runs of ASCII letters (A-Z lowered), digits and all
characters beyond ASCII; null and empty texts have no words and no hits; a benchmark text
without words has no window; a null item id counts as an item with the empty name; items that
repeat an id count once; documents are told apart by id and text, so rows that repeat both get the same result, and a null id is an id like others; an empty benchmark hits nothing; an
empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Stages, pick, table

WINDOW = 10
RAREST = 2
_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_DOC = ["doc_id", "text_hash"]


def words_of(text: Column) -> Column:
    """The words of a text, letters not lowered yet."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(_WORD), F.lit(0))


def lowered(word: Column) -> Column:
    """A-Z lowered and nothing else; for plain ASCII that is lower()."""
    return F.when(F.octet_length(word) == F.char_length(word), F.lower(word)).otherwise(
        F.translate(word, string.ascii_uppercase, string.ascii_lowercase))


def phrases_of(stages: Stages, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """items(item_id, text) -> vocabulary(term, term_id), phrases(phrase_id, item_id)
    and phrase terms(phrase_id, length, offset, term_id).  Windows of equal words
    are one phrase."""
    words = items.select("item_id", F.transform(words_of(F.col("text")), lowered).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - window, F.lit(0)))
    windows = (words.select("item_id", "words", F.explode(starts).alias("at"))
               .select("item_id", F.slice("words", F.col("at") + 1, F.lit(window)).alias("words")).distinct())
    windows = stages.save(windows, "windows")
    named = stages.save(windows.select("words").distinct().withColumn("phrase_id", F.monotonically_increasing_id()), "phrases")
    phrases = windows.join(named, "words").select("phrase_id", "item_id").distinct()
    empty = items.sparkSession.range(1).select(F.lit("").alias("term"))
    terms = named.select(F.explode("words").alias("term")).distinct().unionByName(empty)
    vocabulary = stages.save(terms.coalesce(1).withColumn("term_id", F.monotonically_increasing_id()), "vocabulary")
    parts = (named.select("phrase_id", F.size("words").alias("length"), F.posexplode("words").alias("offset", "term"))
             .join(vocabulary, "term").select("phrase_id", "length", "offset", "term_id"))
    return vocabulary, stages.save(phrases, "phrase-items"), stages.save(parts, "phrase-terms")


def build_index(stages: Stages, docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """docs(doc_id, text) -> postings(doc_id, text_hash, pos, term_id) of the vocabulary's terms."""
    spaced = docs.select("doc_id", F.xxhash64("text").alias("text_hash"),
                         F.posexplode(F.concat(words_of(F.col("text")), F.array(F.lit("")))).alias("pos", "word"))
    return stages.save(spaced.withColumn("term", lowered(F.col("word"))).join(vocabulary, "term")
                       .select(*_DOC, "pos", "term_id"), "postings")


def lengths(postings: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """A row a document row, also for those without any posting: n_words."""
    end = vocabulary.where("term = ''").select("term_id")
    return postings.join(end, "term_id", "left_semi").select(*_DOC, F.col("pos").cast("long").alias("n_words"))


def _by_rarity(postings: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrase terms ranked from the rarest in the corpus; phrases with a term that it lacks are left out."""
    counts = postings.groupBy("term_id").agg(F.count(F.lit(1)).alias("df"))
    ranked = (parts.join(counts, "term_id", "left")
              .withColumn("gone", F.max(F.col("df").isNull()).over(W.partitionBy("phrase_id")))
              .withColumn("rank", F.row_number().over(W.partitionBy("phrase_id").orderBy("df", "offset")) - 1))
    return ranked.where(~F.col("gone")).drop("gone", "df")


def _same_doc(a: str, b: str, *more: str) -> Column:
    return F.expr(" AND ".join([f"{a}.doc_id <=> {b}.doc_id", *(f"{a}.{c} = {b}.{c}" for c in ("text_hash", *more))]))


def _in_docs(stages: Stages, postings: DataFrame, found: DataFrame) -> DataFrame:
    """The postings of the documents in found."""
    docs = stages.save(found.select(*_DOC).distinct(), "candidate-docs")
    return postings.alias("p").join(docs.alias("d"), _same_doc("p", "d"), "left_semi")


def phrase_matches(stages: Stages, postings: DataFrame, parts: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(phrase_id, doc_id, text_hash, start, length): every place where a phrase occurs."""
    ranked = stages.save(_by_rarity(postings, parts), "ranked")
    anchors = stages.save(ranked.where(F.col("rank") < rarest), "anchors")
    # lists moved back by the offsets; a start is left if each of the rarest terms has it
    starts = (postings.join(anchors, "term_id").withColumn("start", F.col("pos") - F.col("offset")).where("start >= 0")
              .groupBy("phrase_id", *_DOC, "start", "length")
              .agg(F.bit_or(F.expr("shiftleft(1, rank)")).alias("have")))
    wanted = F.expr(f"shiftleft(1, least({rarest}, length)) - 1")
    candidates = stages.save(starts.where(F.col("have") == wanted).drop("have"), "candidates")
    expected = candidates.join(ranked.select("phrase_id", "offset", "term_id"), "phrase_id").withColumn(
        "pos", F.col("start") + F.col("offset"))
    here = _in_docs(stages, postings, candidates).distinct()
    return (expected.alias("e").join(here.alias("h"), _same_doc("e", "h", "pos", "term_id"))
            .groupBy("e.phrase_id", "e.doc_id", "e.text_hash", "e.start", "e.length")
            .agg(F.count(F.lit(1)).alias("n")).where("n = length").drop("n"))


def proximity_matches(stages: Stages, postings: DataFrame, parts: DataFrame, within: int) -> DataFrame:
    """(phrase_id, doc_id, text_hash, pos): places of a phrase's rarest term that
    have all its terms at most ``within`` words away on either side.

    Positions fall into cells of ``within`` words; a place looks into its own
    cell and those beside it."""
    distinct = parts.groupBy("phrase_id", "term_id").agg(F.min("offset").alias("offset"), F.lit(0).alias("length"))
    ranked = stages.save(_by_rarity(postings, distinct), "ranked")
    need = ranked.groupBy("phrase_id").agg(F.count(F.lit(1)).alias("terms"))
    at = stages.save(postings.join(ranked.where("rank = 0"), "term_id").select("phrase_id", *_DOC, "pos").distinct(), "places")
    cell = lambda pos: F.floor(pos / F.lit(within + 1))
    asked = (at.join(ranked.select("phrase_id", "term_id"), "phrase_id")
             .withColumn("cell", F.explode(F.sequence(cell(F.col("pos") - within), cell(F.col("pos") + within)))))
    here = _in_docs(stages, postings, at).distinct().withColumn("cell", cell(F.col("pos")))
    near = asked.alias("a").join(here.alias("h"), _same_doc("a", "h", "cell", "term_id")
                                 & (F.abs(F.col("a.pos") - F.col("h.pos")) <= within))
    got = (near.groupBy("a.phrase_id", "a.doc_id", "a.text_hash", "a.pos")
           .agg(F.count_distinct("a.term_id").alias("have")))
    return got.join(need, "phrase_id").where("have = terms").drop("have", "terms")


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, rarest: int = RAREST) -> DataFrame:
    """docs(doc_id, text), items(item_id, text) -> a row a document row: doc_id,
    text_hash, n_words, n_hit, n_items, items (sorted), contaminated."""
    stages = Stages(docs.sparkSession, "decontaminate")
    vocabulary, phrases, parts = phrases_of(stages, items, window)
    postings = build_index(stages, docs, vocabulary)
    found = stages.save(phrase_matches(stages, postings, parts, rarest), "matches")
    stages.keep(found, postings, vocabulary, phrases)
    hit = (found.select(*_DOC, F.explode(F.expr("sequence(start, start + length - 1)")).alias("pos"))
           .distinct().groupBy(*_DOC).agg(F.count(F.lit(1)).alias("n_hit")))
    names = (found.join(phrases, "phrase_id").groupBy(*_DOC)
             .agg(F.array_sort(F.collect_set(F.coalesce(F.col("item_id").cast("string"), F.lit("")))).alias("items")))
    marks = hit.alias("a").join(names.alias("b"), _same_doc("a", "b")).select("a.*", "b.items")
    rows = lengths(postings, vocabulary)
    return rows.alias("r").join(marks.alias("m"), _same_doc("r", "m"), "left").select(
        "r.*", F.coalesce("m.n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("m.items", F.array().cast("array<string>")).alias("items"),
        F.col("m.n_hit").isNotNull().alias("contaminated"))


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text", key: str = "doc_id",
                      window: int = WINDOW) -> DataFrame:
    """The rows of docs, with all their columns, that hold no window of an item."""
    stages = Stages(docs.sparkSession, "decontaminate")
    vocabulary, _, parts = phrases_of(stages, items, window)
    found = phrase_matches(stages, build_index(stages, pick(docs, doc_id=key, text=text), vocabulary), parts)
    bad = stages.save(found.select(F.col("doc_id").alias("_bad_id"), F.col("text_hash").alias("_bad_hash")).distinct(), "bad")
    stages.keep(bad)
    return docs.join(bad, docs[key].eqNullSafe(bad["_bad_id"]) & (F.xxhash64(docs[text]) == bad["_bad_hash"]), "left_anti")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    items = pick(table(spark, sf_dir, "benchmark"), item_id="item_id", text="text")
    out = contamination(docs, items)
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP3_SQL = r"""
WITH low AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
d AS (SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM low),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS p FROM (
  SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(p) AS k FROM win),
spots AS (SELECT doc_id, k, i, w[i:i + k - 1] AS p FROM (
  SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
m AS (SELECT doc_id, item_id, i, k FROM spots JOIN win USING (p)),
hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS pos FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
