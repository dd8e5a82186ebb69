"""The registered queries op1 to op13 and their SQL."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlake.llm import cascade, cuckoo, fim, fingerprints, lbl, mixing, oddsketch, packing, runs, suffixes, tokens, topk, toxicity
from bidlake.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def vocabulary() -> str:
    """Where the public tokenizer lies on this machine; every executor has the same package."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return add


@query()
def op1_token_counts(spark, sf_dir):
    """Tokens of every whole text."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


OP2_SQL = r"""
WITH sized AS (
 SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
  md5(coalesce(doc_id::VARCHAR, '')) AS key
 FROM documents),
totals AS (
 SELECT source, sum(size)::BIGINT AS source_size,
  [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w
 FROM sized GROUP BY source),
turns AS (
 SELECT *, sum(source_size) OVER ()::HUGEINT AS all_size,
  coalesce(sum(source_size) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::HUGEINT AS size_before,
  sum(w) OVER (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::HUGEINT AS w_left,
  row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS turn
 FROM totals),
capped AS (
 SELECT *, 3 * all_size - 4 * size_before AS rest, 4 * source_size * w_left <= w * (3 * all_size - 4 * size_before) AS is_full FROM turns),
aims AS (
 SELECT source, source_size, CASE WHEN is_full THEN 2.0 * source_size ELSE (w * left_rest)::DOUBLE / (2 * left_w)::DOUBLE END::DOUBLE AS target,
  CASE WHEN is_full THEN 2 * source_size ELSE (w * left_rest) // (2 * left_w) END::BIGINT AS budget
 FROM capped CROSS JOIN (SELECT arg_min(rest, turn) FILTER (NOT is_full) AS left_rest, arg_min(w_left, turn) FILTER (NOT is_full) AS left_w FROM capped) x),
ordered AS (
 SELECT s.*, a.source_size, a.target, a.budget,
  CASE WHEN a.source_size > 0 THEN a.budget // a.source_size ELSE 0 END AS passes,
  sum(size) OVER (PARTITION BY s.source ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS before
 FROM sized s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target,
 (passes * size + greatest(0, least(size, budget - passes * source_size - before)))::BIGINT AS taken
FROM ordered
"""


@query(OP2_SQL)
def op2_mix(spark, sf_dir):
    """Words taken of each document for 150% of all words, sources weighing 5, 2, 1."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op3_pack(spark, sf_dir):
    """Pieces of windows of 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary())


@query()
def op4_near_dedup(spark, sf_dir):
    """Near-duplicate component of every document, on sets of four-word shingles."""
    rows = oddsketch.near_groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_shingles", "component_id", "kept")


OP5_SQL = r"""
WITH named AS (
 SELECT doc_id, length(coalesce(text, '')) AS chars,
  sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
 FROM documents),
ranked AS (
 SELECT *, first(doc_id) OVER w AS keep_id, first(chars) OVER w AS keep_chars, count(*) OVER (PARTITION BY text_sha256) AS group_size
 FROM named WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id NULLS LAST))
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND chars = keep_chars AS kept, text_sha256 FROM ranked
"""


@query(OP5_SQL)
def op5_exact_dedup(spark, sf_dir):
    """The row that stays of each group of equal texts."""
    return cuckoo.exact_groups(table(spark, sf_dir, "documents"))


@query()
def op6_toxicity(spark, sf_dir):
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


OP7_SQL = r"""
WITH parts AS (
 SELECT page_id,
  coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
 FROM pages),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
 ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
ruled AS (
 SELECT page_id, host, path, arg_max(h || p, length(h || p)) AS rule, arg_max(verdict, length(h || p)) AS verdict
 FROM (SELECT DISTINCT page_id, host, path FROM parts)
 LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
 GROUP BY page_id, host, path),
judged AS (
 SELECT parts.page_id, parts.host, parts.path, rule, verdict
 FROM parts JOIN ruled ON parts.page_id IS NOT DISTINCT FROM ruled.page_id AND parts.host = ruled.host AND parts.path = ruled.path),
bad AS (
 SELECT host FROM judged WHERE host <> '' GROUP BY host HAVING count(*) FILTER (WHERE verdict = 'block') > count(*) FILTER (WHERE verdict = 'allow'))
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN host IN (SELECT host FROM bad) THEN 'block' ELSE 'allow' END) AS verdict FROM judged
"""


@query(OP7_SQL)
def op7_url_filter(spark, sf_dir):
    """Rule and verdict of every page's url."""
    return cascade.judge(table(spark, sf_dir, "pages"))


@query()
def op8_repeated_passages(spark, sf_dir):
    """What is left of each text without passages of 400 bytes that occur elsewhere too."""
    return suffixes.strike_repeats(table(spark, sf_dir, "documents"))


@query()
def op9_lm_scores(spark, sf_dir):
    """Log probabilities of every text by unigrams and by the log-bilinear model."""
    return lbl.score(table(spark, sf_dir, "documents"))


OP10_SQL = """
WITH fine AS (
 SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
 WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
 SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
 FROM fine q JOIN fine c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v))
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INT AS rank, vec_id, score
FROM scored QUALIFY rank <= 5
"""


@query(OP10_SQL)
def op10_top_k(spark, sf_dir):
    """The five vectors of highest inner product for every fiftieth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


OP11_SQL = r"""
WITH unit AS (
 SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS d,
  regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
 FROM documents),
drawn AS (
 SELECT *, len(u)::BIGINT AS n, ('0x' || d[1:8])::BIGINT AS h1, ('0x' || d[9:16])::BIGINT AS h2,
  ('0x' || d[17:24])::BIGINT AS h3, ('0x' || d[25:32])::BIGINT AS h4
 FROM unit),
cut AS (
 SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
  CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
   WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
 FROM drawn),
pieces AS (
 SELECT *, array_to_string(u[1:lo], '') AS prefix, array_to_string(u[lo + 1:hi], '') AS middle, array_to_string(u[hi + 1:n], '') AS suffix FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
 sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
 sha256(text) AS restored_sha256
FROM pieces
"""


@query(OP11_SQL)
def op11_fill_in_middle(spark, sf_dir):
    """Form, cuts and digests of every text made ready for filling in, and of the text rebuilt from that."""
    rows = fim.restore(fim.fill_in_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


@query()
def op12_fingerprints(spark, sf_dir):
    """Fingerprints of every text and its edited text, and their likeness to each other and to the next document."""
    rows = fingerprints.fingerprints(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


@query()
def op13_periodic_runs(spark, sf_dir):
    """Periodic runs of words of every text, every tenth text made periodic first."""
    rows = runs.periodic_runs(table(spark, sf_dir, "documents"), repeat=True)
    longest = [F.col(f"longest.{c}").alias(c) for c in ("start", "length", "period", "exponent_milli")]
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), *longest, "runs_sha256", F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
