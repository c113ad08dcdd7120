"""The dealt operators as named queries over one input folder, and the SQL twins of some."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlake.llm.decontaminate import contamination
from adlake.llm.embedding import quality_scores
from adlake.llm.jaccard import similarity_components
from adlake.llm.language import predicted_languages
from adlake.llm.licenses import licences
from adlake.llm.mixing import mixed
from adlake.llm.packing import packed_documents
from adlake.llm.rules import quality_rules
from adlake.llm.spelling import spelling_variants
from adlake.llm.substrings import repeated_windows
from adlake.llm.suffixes import repeated_substrings
from adlake.llm.trie import conversation_trie
from adlake.llm.wavelet import tokenized


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_wavelet_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return tokenized(table(spark, folder, "documents"))


def op2_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return predicted_languages(table(spark, folder, "documents"))


def op3_suffix_array(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_substrings(table(spark, folder, "documents"), whole=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return similarity_components(table(spark, folder, "documents"))


def with_domain(docs: DataFrame) -> DataFrame:
    """The domain of a document: the number at the end of its source, modulo 4; domain0 without one."""
    number = F.try_to_number(F.nullif(F.regexp_extract("source", r"(\d{1,9})$", 1), F.lit("")), F.lit("999999999"))
    return docs.withColumn("domain", F.concat(F.lit("domain"), F.coalesce(number.cast("long") % 4, F.lit(0)).cast("string")))


def mix_weights(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """English counts four times as much as any other language of its domain, and src0 half as much as any other source of its leaf's parent."""
    langs = docs.select("domain").distinct().select("domain", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(4).alias("weight"))
    nodes = docs.select("domain", "lang", "source").filter("lang is not null and source is not null").distinct()
    return langs.unionAll(nodes.select("domain", "lang", "source", F.when(F.col("source") == "src0", 1).otherwise(2)))


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = with_domain(table(spark, folder, "documents"))
    return mixed(docs, mix_weights(spark, docs))


def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of their source, language and thousand of ids."""
    docs = table(spark, folder, "documents")
    path = F.concat_ws("/", "source", "lang", F.expr("doc_id div 1000").cast("string"), F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    found = licences(docs.select(F.col("doc_id").alias("file"), path.alias("path"), "text"))
    return found.withColumnRenamed("file", "doc_id")


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = repeated_windows(table(spark, folder, "documents"), whole=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op8_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Trusted: what labels mark as of quality 1."""
    trusted = table(spark, folder, "labels").filter("quality = 1")
    return quality_rules(table(spark, folder, "documents"), trusted)


def op11_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, empty texts and repeated rows as in ``packed_documents``."""
    return packed_documents(table(spark, folder, "documents"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, empty texts and repeated rows as in ``spelling_variants``."""
    return spelling_variants(table(spark, folder, "documents"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Nulls, ties and repeated rows as in ``conversation_trie``."""
    return conversation_trie(table(spark, folder, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_wavelet_tokens": op1_wavelet_tokens,
    "op2_language_id": op2_language_id,
    "op3_suffix_array": op3_suffix_array,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_source_mix": op5_source_mix,
    "op6_license_scan": op6_license_scan,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_quality_classifier": op8_quality_classifier,
    "op9_decontamination": op9_decontamination,
    "op10_quality_rules": op10_quality_rules,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_conversation_trie": op13_conversation_trie,
}

def _crc32(text: str) -> str:
    """Unsigned crc32 of an SQL string expression's UTF-8 bytes."""
    octet = f"('0x' || substr(hex(encode({text})), 2 * k + 1, 2))::BIGINT"
    step = "CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    octets = f"list_prepend(4294967295::BIGINT, list_transform(range(0, octet_length(encode({text}))), lambda k: {octet}))"
    return f"(4294967295 - list_reduce({octets}, lambda c, b: list_reduce(list_prepend(xor(c, b), range(0, 8)), lambda x, i: {step})))"


ORACLES: dict[str, str] = {
    "op5_source_mix": r"""
WITH d AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    'domain' || coalesce(TRY_CAST(nullif(regexp_extract(source, '(\d{1,9})$', 1), '') AS BIGINT) % 4, 0) AS domain,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS n_tokens
  FROM documents),
leaf AS MATERIALIZED (SELECT domain, lang, source, sum(n_tokens)::HUGEINT AS n, 3 * sum(n_tokens)::HUGEINT AS cap, CASE WHEN source = 'src0' THEN 1 ELSE 2 END AS w FROM d GROUP BY ALL),
a0 AS (SELECT domain, sum(cap) AS cap, 1 AS w, (SELECT sum(n) FROM leaf) AS budget FROM leaf GROUP BY ALL),
a1 AS (SELECT *, budget - coalesce(sum(cap) OVER (ORDER BY cap / w, domain ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l, sum(w) OVER (ORDER BY cap / w, domain ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM a0),
a2 AS (SELECT *, l > 0 AND cap * ws <= l * w AS f FROM a1),
a3 AS (SELECT *, budget - coalesce(sum(cap) FILTER (f) OVER (), 0) AS rest, sum(w) FILTER (NOT f) OVER () AS sh FROM a2),
a AS (SELECT domain, CASE WHEN f THEN cap WHEN sh > 0 THEN (rest * w) // sh ELSE 0 END AS share FROM a3),
b0 AS (SELECT domain, lang, sum(cap) AS cap, CASE WHEN lang = 'en' THEN 4 ELSE 1 END AS w, any_value(a.share) AS budget FROM leaf JOIN a USING (domain) GROUP BY ALL),
b1 AS (SELECT *, budget - coalesce(sum(cap) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l, sum(w) OVER (PARTITION BY domain ORDER BY cap / w, lang ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM b0),
b2 AS (SELECT *, l > 0 AND cap * ws <= l * w AS f FROM b1),
b3 AS (SELECT *, budget - coalesce(sum(cap) FILTER (f) OVER (PARTITION BY domain), 0) AS rest, sum(w) FILTER (NOT f) OVER (PARTITION BY domain) AS sh FROM b2),
b AS (SELECT domain, lang, CASE WHEN f THEN cap WHEN sh > 0 THEN (rest * w) // sh ELSE 0 END AS share FROM b3),
c0 AS (SELECT leaf.*, b.share AS budget FROM leaf JOIN b USING (domain, lang)),
c1 AS (SELECT *, budget - coalesce(sum(cap) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS l, sum(w) OVER (PARTITION BY domain, lang ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS ws FROM c0),
c2 AS (SELECT *, l > 0 AND cap * ws <= l * w AS f FROM c1),
c3 AS (SELECT *, budget - coalesce(sum(cap) FILTER (f) OVER (PARTITION BY domain, lang), 0) AS rest, sum(w) FILTER (NOT f) OVER (PARTITION BY domain, lang) AS sh FROM c2),
c AS (SELECT domain, lang, source, n, CASE WHEN f THEN cap WHEN sh > 0 THEN (rest * w) // sh ELSE 0 END AS share FROM c3),
plan AS MATERIALIZED (SELECT domain, lang, source, CAST(CASE WHEN n > 0 THEN share // n ELSE 0 END AS BIGINT) AS epochs, CAST(share - CASE WHEN n > 0 THEN share // n ELSE 0 END * n AS BIGINT) AS r FROM c),
uses AS (
  SELECT doc_id, d.domain, d.lang, d.source, unnest(range(0, epochs)) AS epoch, n_tokens, n_tokens AS taken FROM d JOIN plan USING (domain, lang, source)
  UNION ALL
  SELECT doc_id, domain, lang, source, epochs, n_tokens, least(n_tokens, r - s) FROM (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('17:' || epochs || ':' || doc_id), doc_id, n_tokens ROWS UNBOUNDED PRECEDING) - n_tokens AS s
    FROM d JOIN plan USING (domain, lang, source) WHERE r > 0) WHERE s < r)
SELECT doc_id, domain, lang, source, CAST(epoch AS BIGINT) AS epoch, n_tokens, CAST(taken AS BIGINT) AS taken FROM uses
""",
    "op7_substring_dedup": r"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
win AS MATERIALIZED (
  SELECT doc_id, i, md5(array_to_string(words[i : i + 12], ' ')) AS h
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
hit AS (SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY h) AS m FROM win) WHERE doc_id > m),
gone AS MATERIALIZED (SELECT DISTINCT doc_id, i + unnest(range(0, 13)) AS i FROM hit),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1),
kept AS (
  SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS t
  FROM (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM w) p
  ANTI JOIN gone g ON p.doc_id = g.doc_id AND p.i = g.i
  GROUP BY 1)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(lost.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
FROM w LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)
""",
    "op12_spelling_variants": r"""
WITH runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents WHERE doc_id IS NOT NULL) GROUP BY ALL),
h AS MATERIALIZED (SELECT run, n, """
    + _crc32("doc_id || ':' || run")
    + r""" AS h FROM runs),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
holes AS MATERIALIZED (SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
pairs AS (
  SELECT DISTINCT a.word, b.word AS other, b.n FROM holes a JOIN holes b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
  UNION
  SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.rest = b.word
  UNION
  SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(n) AS m FROM pairs GROUP BY word),
form AS MATERIALIZED (SELECT word, min(other) AS form, any_value(m) AS form_n, any_value(n_near) AS n_near FROM pairs JOIN best USING (word) WHERE pairs.n = m GROUP BY word),
told AS MATERIALIZED (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * words.n THEN form END AS form, CASE WHEN form_n >= 10 * words.n THEN form_n END AS form_n
  FROM words LEFT JOIN form USING (word)),
walk AS (
  WITH RECURSIVE w AS (SELECT word, word AS root FROM told UNION ALL SELECT w.word, told.form FROM w JOIN told ON told.word = w.root WHERE told.form IS NOT NULL)
  SELECT w.word, w.root FROM w JOIN told ON told.word = w.root WHERE told.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM told JOIN walk USING (word)
""",
    "op13_conversation_trie": r"""
WITH turns AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, turn FROM conversations WHERE conv_id IS NOT NULL),
own AS MATERIALIZED (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, md5(octet_length(encode(role)) || ':' || role || text)) AS l FROM turns GROUP BY 1),
h AS MATERIALIZED (SELECT conv_id, """
    + _crc32("conv_id::VARCHAR")
    + r""" % 6 AS h FROM own),
built AS MATERIALIZED (
  SELECT conv_id, coalesce(b.l, [])[1:h] || own.l[h + 1:] AS l
  FROM own JOIN h USING (conv_id) LEFT JOIN (SELECT conv_id AS base, l FROM own) b ON b.base = conv_id - conv_id % 100),
step AS MATERIALIZED (
  SELECT conv_id, d, len(l) = d AS ends, md5(l[1:d]::JSON::VARCHAR) AS k, CASE WHEN d > 0 THEN md5(l[1:d - 1]::JSON::VARCHAR) END AS p,
    CASE WHEN d > 0 THEN length(l[d].text) ELSE 0 END AS chars, l
  FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM built)),
node AS MATERIALIZED (
  SELECT k, any_value(d) AS d, any_value(p) AS p, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends
  FROM step GROUP BY k),
kids AS (SELECT p, count(*) AS c FROM node WHERE p IS NOT NULL GROUP BY p),
up AS (
  SELECT DISTINCT a.k, b.k AS top FROM step a JOIN node ON node.k = a.k AND node.conv_id = a.conv_id JOIN step b ON a.conv_id = b.conv_id AND b.d <= a.d),
sums AS (
  SELECT top, sum((n - 1) * chars) AS saved, count(*) FILTER (kids.c IS NULL) AS leaves
  FROM up JOIN node ON up.k = node.k LEFT JOIN kids ON kids.p = node.k GROUP BY top)
SELECT node.conv_id, node.d AS depth, above.conv_id AS parent_conv_id, node.n AS n_convs, CAST(coalesce(kids.c, 0) AS BIGINT) AS n_children,
  CAST(leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, node.ends AS ends_sha256
FROM node JOIN sums ON top = node.k LEFT JOIN kids ON kids.p = node.k LEFT JOIN node above ON above.k = node.p
""",
}
