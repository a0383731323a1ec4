"""One registered query per operator, over whole tables, with SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgepulse.llm import (
    alignment, bitplanes, collocations, decontaminate, language, licenses, line_dedup, minhash, packing,
    quality, secrets, sharding, warc,
)
from forgepulse.llm.common import ship, table
from forgepulse.session import prepare, scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship(spark)
            return build(prepare(spark), sf_dir)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return run

    return register


@query(f"""
WITH split AS (
  SELECT doc_id, text, str_split(coalesce(text, ''), chr(10)) AS lines FROM documents
),
numbered AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS line_no FROM split
),
seq AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM numbered WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')
),
summed AS (
  SELECT *, sum(n) OVER (PARTITION BY doc_id ORDER BY pos) - n AS before FROM seq
),
forward AS (
  SELECT a.doc_id, a.pos, a.line_no AS first_line, max(b.line_no) AS last_line,
         string_agg(b.line, chr(10) ORDER BY b.pos) AS content, sum(b.n) AS total
  FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND b.pos >= a.pos AND b.before < a.before + {line_dedup.MIN_WORDS}
  GROUP BY ALL
),
backward AS (
  SELECT b.doc_id, b.pos, min(a.line_no) AS first_line, b.line_no AS last_line,
         string_agg(a.line, chr(10) ORDER BY a.pos) AS content, sum(a.n) AS total
  FROM summed a JOIN summed b
    ON a.doc_id = b.doc_id AND a.pos <= b.pos
    AND a.before + a.n > b.before + b.n - {line_dedup.MIN_WORDS}
  GROUP BY ALL
),
windows AS (SELECT 1 AS way, * FROM forward UNION ALL SELECT 2 AS way, * FROM backward),
copies AS (
  SELECT doc_id, first_line, last_line FROM (
    SELECT *, row_number() OVER (PARTITION BY way, content ORDER BY doc_id, pos) AS nth
    FROM windows WHERE total >= {line_dedup.MIN_WORDS})
  WHERE nth > 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(first_line, last_line + 1)) AS line_no FROM copies),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY line_no) AS clean
  FROM numbered ANTI JOIN gone USING (doc_id, line_no) GROUP BY doc_id
),
counts AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY doc_id)
SELECT doc_id, cast(len(lines) AS bigint) AS n_lines, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(clean, '')) AS clean_sha256
FROM split LEFT JOIN counts USING (doc_id) LEFT JOIN kept USING (doc_id)""")
def op1_line_dedup(spark, sf_dir):
    """Lines of each document, how many were later copies, and the text that is left."""
    lengths = F.transform("runs", lambda r: r["end"] - r["start"] + 1)
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), whole=True).select(
        "doc_id",
        F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("bigint").alias("n_lines"),
        F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, n: a + n).alias("n_removed"),
        F.sha2(F.coalesce("clean_text", F.lit("")), 256).alias("clean_sha256"),
    )


@query()
def op8_quality_rules(spark, sf_dir):
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    return quality.judged(table(spark, sf_dir, "documents"), trusted).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "score",
    )


@query(r"""
WITH doc AS (
  SELECT doc_id, list_filter(
    str_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
),
item AS (
  SELECT item_id, list_filter(
    str_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                              'abcdefghijklmnopqrstuvwxyz'),
                    '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
),
item_window AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
         array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS span
  FROM item, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(i) WHERE len(w) > 0
),
doc_window AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS span
  FROM doc, unnest(range(1, len(w) + 1)) AS t(i), (SELECT DISTINCT n FROM item_window)
  WHERE i + n - 1 <= len(w)
),
hit AS (SELECT doc_id, i, n, item_id FROM doc_window JOIN item_window USING (n, span)),
words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM hit, unnest(range(i, i + n)) AS t(p) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT cast(item_id AS varchar), ',' ORDER BY cast(item_id AS varchar)) AS ids
  FROM hit GROUP BY doc_id
)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op4_decontamination(spark, sf_dir):
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    n_hit = F.size("hit_words").cast("bigint")
    return decontaminate.contamination(docs, benchmark).select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.size("hit_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query()
def op3_minhash_near_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id", "kept"
    )


@query()
def op5_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query()
def op9_sharding(spark, sf_dir):
    return sharding.shard_documents(table(spark, sf_dir, "documents"), 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query()
def op10_token_ids(spark, sf_dir):
    return bitplanes.round_trip(table(spark, sf_dir, "documents"))


@query("""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages
)
SELECT page_id, cast(strlen(html) AS bigint) AS payload_bytes,
       (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                                 1 + cast(('0b' || substr(bits, i, 5)) AS int), 1), '' ORDER BY i)
        FROM range(1, 161, 5) AS t(i)) AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT *, cast(cast(unhex(sha1(html)) AS bit) AS varchar) AS bits FROM p)""")
def op2_warc(spark, sf_dir):
    """Pages written as archives and read back: responses with their payloads checked,
    revisits by their headers alone."""
    path = scratch_path(spark, "warc")
    warc.archive_pages(table(spark, sf_dir, "pages"), path)
    columns = "record_id string, record_type string, refers_to string, payload_digest string, payload_bytes bigint"
    responses = warc.archived(spark, path, columns, verify="true").where("record_type = 'response'")
    revisits = warc.archived(spark, path, columns).where("record_type = 'revisit'")
    page = lambda c: F.regexp_extract(c, r":page:(-?\d+)>", 1).try_cast("bigint")
    return responses.unionByName(revisits).select(
        page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        page("refers_to").alias("refers_to"),
    )


@query()
def op6_secret_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    trusted = quality.trusted_ids(table(spark, sf_dir, "labels"))
    samples = secrets.random_strings(docs).unionByName(secrets.ordinary_words(docs, trusted))
    of_kind = lambda k: F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("bigint")
    return secrets.find_secrets(docs, samples).select(
        "doc_id",
        of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(secrets.listed(F.col("base_spans")), 256).alias("base_sha256"),
        secrets.listed(F.col("all_spans")).alias("spans"),
    )


@query()
def op7_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = F.transform("found", lambda f: f["license"])
    places = F.transform("found", lambda f: F.concat_ws(":", f["license"], f["start"].cast("string"), f["end"].cast("string")))
    return licenses.scan_licenses(docs).select(
        "doc_id",
        F.array_join(F.array_sort(F.array_distinct(names)), ",").alias("licenses"),
        F.size("found").cast("bigint").alias("n_found"),
        F.array_join(places, ",").alias("places"),
    )


@query()
def op11_token_alignment(spark, sf_dir):
    aligned = alignment.align_documents(table(spark, sf_dir, "documents"), digest=True)
    return aligned.withColumnRenamed("groups", "groups_sha256")


@query()
def op12_language_id(spark, sf_dir):
    return language.identify_languages(table(spark, sf_dir, "documents"))


@query(r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(str_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
seq AS (
  SELECT lang, list_filter(str_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece
),
gram AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f
  FROM seq, (SELECT unnest(range(1, 6)) AS k), unnest(range(1, len(w) - k + 2)) AS t(i)
  GROUP BY ALL
),
size AS (SELECT lang, cast(sum(f) AS bigint) AS n FROM gram WHERE k = 1 GROUP BY lang),
candidate AS (
  SELECT lang, k, phrase, f AS a, str_split(phrase, ' ') AS w FROM gram WHERE k > 1 AND f >= 100
),
cut AS (
  SELECT c.lang, c.phrase, c.w, c.k, c.a, c.j, l.f AS l, r.f AS r, n,
         cast((1000::hugeint * c.a * n) // (l.f::hugeint * r.f) AS bigint) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidate) c
  JOIN gram l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : j], ' ')
  JOIN gram r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1 : c.k], ' ')
  JOIN size ON size.lang = c.lang
),
best AS (
  SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
),
part AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS longer
  FROM candidate, (SELECT unnest(range(2, 5)) AS m), unnest(range(1, k - m + 2)) AS t(i)
  WHERE m < k GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score
FROM best LEFT JOIN part USING (lang, phrase)
WHERE longer IS NULL OR 100 * longer < 100 * a
QUALIFY rank <= 2000""")
def op13_collocations(spark, sf_dir):
    return collocations.mine_phrases(table(spark, sf_dir, "documents"))
