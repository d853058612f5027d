"""The registered queries opN_<name>: each applies its operator, with
production parameters, to the whole given table.  ORACLE has DuckDB SQL where
SQL can express the result; tests hold the other queries (seeded hashes,
tokenizers, compressors, trained models) against brute force."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playlens.llm.alignment import align_corpus
from playlens.llm.common import pick, scratch_path, ship, table
from playlens.llm.chat import events_of, format_events, read_back
from playlens.llm.decontaminate import mark_contamination
from playlens.llm import idcoder
from playlens.llm.fingerprints import fingerprint_documents
from playlens.llm.license_scan import scan_licenses
from playlens.llm.line_dedup import dedup_lines
from playlens.llm.packing import pack_documents
from playlens.llm.phrases import collocations
from playlens.llm.sharding import shuffle_into_shards
from playlens.llm.simhash_dedup import simhash_dedup
from playlens.llm.tokens import default_path, tokenizer_file, vocabulary_size
from playlens.llm.toxicity import fit_on_labels, held_out, score_documents
from playlens.llm.vector_dedup import vector_dedup

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


@query
def op1_license_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document with notices: how many, and the templates they follow."""
    found = scan_licenses(table(spark, sf_dir, "documents"))
    return found.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_notices"), F.array_join(F.array_sort(F.collect_set("template")), ",").alias("templates"),
        F.max("reduction").alias("best_reduction"), F.sum(F.col("missing") + F.col("foreign")).alias("n_differences"))


@query
def op2_dictionary_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every whole text."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_on_labels(docs, labels)
    return score_documents(pick(docs, doc_id="doc_id", text="text"), model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query
def op3_line_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated and nearly repeated lines."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    return dedup_lines(docs.withColumn("before", F.size(F.split("text", "\n")).cast("long")), least=0.8).select(
        "doc_id", F.col("before").alias("n_lines"), F.col("lines_removed").cast("long").alias("lines_removed"), "text")


@query
def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten-word windows of all benchmark items against all documents."""
    docs = pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text")
    marked = mark_contamination(docs, table(spark, sf_dir, "benchmark"))
    n_hit = F.size("hit_words").cast("long")
    return marked.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("hit_items"), ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


@query
def op5_two_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, shuffled, in 24 shards of equal row counts."""
    sharded = shuffle_into_shards(table(spark, sf_dir, "documents"), "doc_id", "text", shards=24)
    return sharded.select(
        F.col("key").alias("doc_id"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted and read back."""
    extra = spark.sql("""SELECT CAST(-7 AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, role, '</s>[INST] ok [/INST]' text
                         FROM VALUES (0, 'user'), (1, 'assistant') t(turn, role)""")
    rows = pick(table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text")
    back = read_back(format_events(events_of(rows.unionByName(extra))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = back.select("conv_id", F.struct("part", said.alias("said"), F.array_join("loss", "").alias("loss"),
                                            F.size("turns").alias("n"), "chars").alias("p"))
    whole = parts.groupBy("conv_id").agg(F.array_sort(F.collect_list("p")).alias("ps"),
                                         F.sum("p.n").alias("n_turns"), F.sum("p.chars").alias("formatted_chars"))
    loss = F.array_join(F.col("ps.loss"), "")
    return whole.select("conv_id", F.col("n_turns").cast("long").alias("n_turns"),
                        F.sha2(F.array_join(F.col("ps.said"), ""), 256).alias("turns_sha256"),
                        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                        F.col("formatted_chars").cast("long").alias("formatted_chars"))


@query
def op7_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors, linked at cosine 0.95 or more."""
    return vector_dedup(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", least=0.95)


@query
def op8_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash over 4-word shingles, links at 4 or fewer differing bits."""
    return simhash_dedup(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query
def op6_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' ids, written by the range coder and read back."""
    path, vocabulary = scratch_path(spark, "id-files"), default_path()
    idcoder.write_ids(table(spark, sf_dir, "documents"), path, vocabulary, end_id=2)
    return idcoder.read_documents(spark, path, vocabulary_size(vocabulary))


@query
def op10_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens, each ended by id 0."""
    return pack_documents(table(spark, sf_dir, "documents"), default_path(), capacity=2048, end_id=0)


@query
def op11_shared_cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents aligned between a byte-level and a piece vocabulary."""
    return align_corpus(table(spark, sf_dir, "documents"), default_path(), tokenizer_file("piece_bpe_32k.model"))


@query
def op12_toivonen_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collocations of two and three words of every language."""
    return collocations(table(spark, sf_dir, "documents"), least=10, keep_share=50, top=2000)


@query
def op13_bottom_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of all documents and of their edited texts."""
    return fingerprint_documents(table(spark, sf_dir, "documents"))


ORACLE["op9_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(17 + 2 * length(role || text) - length(replace(replace(replace(role || text, chr(92), ''), '<', ''), '[', ''))) AS chars
  FROM rows GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars FROM said"""

ORACLE["op4_decontaminate"] = r"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS k, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS i FROM item_words WHERE len(ws) > 0) x),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws FROM documents),
places AS (
  SELECT d.doc_id, k.k, i, array_to_string(ws[i:i + k.k - 1], ' ') AS w
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM doc_words) d, (SELECT DISTINCT k FROM windows) k
  WHERE i + k.k - 1 <= len(ws)),
hits AS (SELECT p.doc_id, p.k, p.i, v.item_id FROM places p JOIN windows v ON p.k = v.k AND p.w = v.w),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) x GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) x GROUP BY doc_id)
SELECT d.doc_id, len(d.ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

ORACLE["op12_toivonen_phrases"] = r"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents) x),
grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM pieces, (SELECT unnest([1, 2, 3]) AS k) ks WHERE len(ws) >= k) x),
freq AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM freq WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM freq WHERE k >= 2 AND f >= 10),
cuts AS (
  SELECT c.lang, c.k, c.phrase, c.a, cut, l.f AS l, r.f AS r, (1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM cand) c
  JOIN freq l ON l.lang = c.lang AND l.k = cut AND l.phrase = array_to_string(ws[1:cut], ' ')
  JOIN freq r ON r.lang = c.lang AND r.k = c.k - cut AND r.phrase = array_to_string(ws[cut + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_pairs AS (
  SELECT lang, array_to_string(ws[i:i + 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE k = 3) x GROUP BY ALL),
kept AS (
  SELECT b.* FROM lowest b LEFT JOIN inner_pairs p ON p.lang = b.lang AND p.phrase = b.phrase AND b.k = 2
  WHERE p.longer IS NULL OR 100 * p.longer < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept JOIN total USING (lang)
QUALIFY rank <= 2000"""
