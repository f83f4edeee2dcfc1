"""The registered query of each training-data operator, over the driver's whole tables."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkmart.llm import chat, merkle, variants
from linkmart.llm.ann import nearest
from linkmart.llm.bpe import decode_ids, encode_texts
from linkmart.llm.common import crc_mod
from linkmart.llm.decontam import contaminated
from linkmart.llm.langid import label_documents
from linkmart.llm.lm import score_documents
from linkmart.llm.packing import pack_documents
from linkmart.llm.pii import pseudonymise
from linkmart.llm.simhash import simhash_components
from linkmart.llm.toxicity import score_toxicity
from linkmart.llm.warc import archive_and_index


#: Of the registered queries; a real corpus has its own secret.
PSEUDONYM_KEY = "linkmart-pseudonyms"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public byte-level BPE vocabulary installed beside the libraries."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, PSEUDONYM_KEY, count_col="n_replaced")


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(r"\### Assistant: </turn> ok").alias("text"))
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    nodes, members = chat.prefix_tree(spark, turns, tokenizer_path())
    return chat.digests(chat.read_back(nodes, members, tokenizer_path())).withColumnRenamed("conv", "conv_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        F.col("id").alias("doc_id"), "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("id", "doc_id")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(spark, _table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = label_documents(spark, _table(spark, sf_dir, "documents"), crc_mod("id", 4) == 2)
    return found.withColumnRenamed("id", "doc_id")


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_documents(spark, _table(spark, sf_dir, "documents"), crc_mod("id", 7) == 2)
    return found.withColumnRenamed("id", "doc_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``pages`` has no capture time: a page's is its id in seconds (modulo a year) from 2024."""
    at = F.timestamp_seconds(F.lit(1_704_067_200) + F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(31_536_000)))
    captures = _table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", at.alias("at"), F.col("html").alias("payload"))
    return archive_and_index(spark, captures).select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark, _table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = score_toxicity(
        spark, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), crc_mod("id", 5) == 0)
    return found.withColumnRenamed("id", "doc_id")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = encode_texts(spark, _table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode_ids(spark, encoded, ranks).select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = variants.letter_runs(_table(spark, sf_dir, "documents"))
    words = variants.word_counts(variants.drop_some_letters(runs, every=199), min_chars=6, min_count=5)
    return variants.group_variants(spark, words)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    fields = ["doc_id", "source", "lang", "n_chars"]
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    leaves = docs.select(
        "doc_id", "lang", merkle.leaf_digest(*fields, "text").alias("leaf"),
        F.when(crc_mod("doc_id", 3) == 0, merkle.leaf_digest(*fields, lowered)).alias("tampered"))
    proved = merkle.manifest(spark, leaves, "lang", "doc_id")
    folded = merkle.fold(F.coalesce("row.tampered", "leaf"), F.col("proof"))
    return proved.select(
        "row.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


QUERIES = {
    "op1_pii": op1_pii,
    "op2_chat": op2_chat,
    "op3_packing": op3_packing,
    "op4_decontamination": op4_decontamination,
    "op5_simhash": op5_simhash,
    "op6_language_id": op6_language_id,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_warc": op8_warc,
    "op9_ann": op9_ann,
    "op10_toxicity": op10_toxicity,
    "op11_bpe": op11_bpe,
    "op12_variants": op12_variants,
    "op13_merkle": op13_merkle,
}

#: crc32 of a list of bytes in DuckDB SQL, which has no such function.
_CRC_TABLE = """
crc_table AS MATERIALIZED (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), CAST(range(8) AS BIGINT[])),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
)"""


def _crc(byte_list: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295, CAST({byte_list} AS BIGINT[])), "
            "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)")


_ID_BYTES = "list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda x: unicode(x))"

#: The others have no SQL form (models, tokenizers, XXH64, look-around patterns); their
#: tests compare them with brute force.
ORACLE_SQL: dict[str, str] = {
    "op2_chat": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
x AS (
  SELECT *, '### ' || regexp_replace(role, '([\\:#<])', '\\\1', 'g') || ': '
            || regexp_replace(text, '(\\|###|</turn>)', '\\\1', 'g') || '</turn>' || chr(10) AS segment
  FROM t
)
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id""",
    "op8_warc": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages
),
m AS (
  SELECT digest, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY digest HAVING count(*) > 1
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN top IS NOT NULL AND page_id IS DISTINCT FROM top THEN top END AS refers_to
FROM p LEFT JOIN m ON p.digest = m.digest""",
    # all pairs of words of about one length; letters beyond ASCII as single bytes for levenshtein
    "op12_variants": f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
),
counted AS (SELECT doc_id, run, count(*) AS k FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, k, {_crc("list_concat(" + _ID_BYTES + ", [58], flatten(list_transform(string_split(run, ''), lambda x: "
                       "CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)))")} AS h
  FROM counted, crc_table
),
words AS MATERIALIZED (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2)
              ELSE run END AS word, CAST(sum(k) AS BIGINT) AS n
  FROM hashed GROUP BY word HAVING length(word) >= 6 AND sum(k) >= 5
),
plain AS MATERIALIZED (
  SELECT word, n, length(word) AS len, translate(word, (SELECT string_agg(chr(CAST(192 + i AS INTEGER)), '' ORDER BY i) FROM range(64) r(i)),
    (SELECT string_agg(chr(CAST(32 + i AS INTEGER)), '' ORDER BY i) FROM range(64) r(i))) AS p FROM words
),
near AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n
  FROM plain a JOIN plain b ON b.len BETWEEN a.len - 1 AND a.len + 1 AND a.word <> b.word AND levenshtein(a.p, b.p) = 1
),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other,
         first(other_n ORDER BY other_n DESC, other) AS other_n
  FROM near GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
         CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
),
chain AS (
  SELECT word, word AS root FROM formed WHERE form IS NULL
  UNION ALL SELECT f.word, c.root FROM formed f JOIN chain c ON f.form = c.word
)
SELECT f.word, n, CAST(n_near AS BIGINT) AS n_near, form, form_n, root FROM formed f JOIN chain c ON f.word = c.word""",
    # a node's place in its run follows from its number on its level
    "op13_merkle": f"""
WITH RECURSIVE {_CRC_TABLE},
fields AS (
  SELECT doc_id, lang, concat(*COLUMNS(lambda c: c LIKE 'f_%')) AS whole, f_doc, f_source, f_lang, f_chars, text
  FROM (SELECT doc_id, lang, text,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') AS f_doc,
    coalesce(octet_length(encode(source)) || ':' || source, '-') AS f_source,
    coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS f_lang,
    coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS f_chars FROM documents)
),
rows AS MATERIALIZED (
  SELECT doc_id, lang, sha256(whole || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         CASE WHEN {_crc(_ID_BYTES)} % 3 = 0 THEN sha256(whole || coalesce(octet_length(encode(text)) || ':' ||
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS tampered
  FROM fields, crc_table
),
leaves AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY lang) AS size FROM rows
),
low AS MATERIALIZED (
  SELECT 0 AS level, lang, place, size, leaf AS digest FROM leaves
  UNION ALL
  SELECT any_value(level) + 1, lang, place // 8, any_value((size + 7) // 8), sha256(string_agg(digest, '' ORDER BY place))
  FROM low WHERE size > 1 GROUP BY lang, place // 8
),
subroots AS MATERIALIZED (
  SELECT lang, digest AS subroot, level AS height, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, count(*) OVER () AS trees
  FROM low WHERE size = 1
),
high AS MATERIALIZED (
  SELECT 0 AS level, tree AS place, trees AS size, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, place // 8, any_value((size + 7) // 8), sha256(string_agg(digest, '' ORDER BY place))
  FROM high WHERE size > 1 GROUP BY place // 8
),
runs AS MATERIALIZED (
  SELECT s.tree, l.level, l.place // 8 AS run, list(l.digest ORDER BY l.place) AS digests
  FROM low l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang WHERE l.size > 1 GROUP BY ALL
  UNION ALL
  SELECT s.tree, s.height + h.level, h.place // 8, list(h.digest ORDER BY h.place)
  FROM subroots s, high h WHERE h.size > 1 GROUP BY ALL
),
walk AS (
  SELECT l.doc_id, l.leaf, s.subroot, s.tree, s.height, 0 AS level, l.place, coalesce(tampered, leaf) AS folded, '' AS proof
  FROM leaves l JOIN subroots s ON l.lang IS NOT DISTINCT FROM s.lang
  UNION ALL
  SELECT w.doc_id, w.leaf, w.subroot, w.tree, w.height, w.level + 1, p // 8,
         sha256(array_to_string(digests[:p % 8], '') || folded || array_to_string(digests[p % 8 + 2:], '')),
         proof || array_to_string(digests[:p % 8], '') || array_to_string(digests[p % 8 + 2:], '')
  FROM (SELECT *, CASE WHEN level = height THEN tree ELSE place END AS p FROM walk) w
  JOIN runs r ON r.tree = w.tree AND r.level = w.level AND r.run = w.p // 8
)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM walk w, (SELECT digest AS root FROM high WHERE size = 1)
WHERE w.level = w.height + (SELECT max(level) FROM high)""",
}
