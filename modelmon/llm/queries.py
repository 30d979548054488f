"""The text operators as queries over the given tables, and the SQL they must equal where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from modelmon.llm import (
    collocations, decontaminate, html_region, licenses, mixing, negatives, quality, secrets, simhash, simple8b, substrings, trie_counts, warc,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

# The vocabulary file of op4; its place is a parameter of the operator.
TOKENIZER = "byte_bpe_50k.json"
# The vocabulary of op5.
UNIGRAM = "piece_bpe_32k.model"


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``."""

    def keep(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op3_simhash")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


@query("op4_simple8b")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_table(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER))


@query("op7_quality")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def _weights_sql(name: str, weights: dict[str, float]) -> str:
    cases = " ".join(f"WHEN {name} = '{k}' THEN {v:.1f}::DOUBLE" for k, v in weights.items())
    return f"CASE {cases} ELSE {mixing.OTHER_WEIGHT:.1f}::DOUBLE END" if cases else f"{mixing.OTHER_WEIGHT:.1f}::DOUBLE"


def mixture_sql(documents: str, share: float, epochs: int, seed: int = mixing.SEED) -> str:
    """Common table expressions that end in ``mixed``: every column of ``documents``, n_tokens and copies."""

    def spread(out: str, nodes: str, family: str, name: str) -> str:
        part = f"PARTITION BY {family}" if family else ""
        return f"""
    {out}_l AS (SELECT *, (family_budget - coalesce(sum(capacity) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
        / sum(weight) OVER ({part} ORDER BY capacity / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv FROM {nodes}),
    {out} AS (SELECT *, greatest(0.0, least(capacity, max(lv) OVER ({part}) * weight)) AS budget FROM {out}_l)"""

    return f"""
    base AS (
        SELECT *, coalesce(source, '') AS leaf, coalesce(lang, '') AS language,
            CASE WHEN regexp_extract(coalesce(source, ''), '([0-9]+)$', 1) = '' THEN 'other'
                 ELSE 'd' || (right(regexp_extract(source, '([0-9]+)$', 1), 6)::INT % 4)::VARCHAR END AS domain,
            len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS n_tokens
        FROM {documents}),
    leaves AS (SELECT domain, language, leaf, sum(n_tokens)::BIGINT AS tokens FROM base GROUP BY ALL),
    n1 AS (SELECT domain, sum(tokens * {epochs})::DOUBLE AS capacity, {_weights_sql("domain", mixing.DOMAIN_WEIGHTS)} AS weight,
        (SELECT floor(coalesce(sum(tokens), 0) * {share}::DOUBLE) FROM leaves) AS family_budget FROM leaves GROUP BY domain),
    {spread("b1", "n1", "", "domain").strip()},
    n2 AS (SELECT domain, language, sum(tokens * {epochs})::DOUBLE AS capacity, {_weights_sql("language", mixing.LANGUAGE_WEIGHTS)} AS weight,
        any_value(b1.budget) AS family_budget FROM leaves JOIN b1 USING (domain) GROUP BY domain, language),
    {spread("b2", "n2", "domain", "language").strip()},
    n3 AS (SELECT domain, language, leaf, (tokens * {epochs})::DOUBLE AS capacity, {_weights_sql("leaf", mixing.SOURCE_WEIGHTS)} AS weight,
        b2.budget AS family_budget, tokens FROM leaves JOIN b2 USING (domain, language)),
    {spread("b3", "n3", "domain, language", "leaf").strip()},
    plan AS (SELECT domain, language, leaf,
        CASE WHEN tokens > 0 THEN floor(budget)::BIGINT // tokens ELSE 0 END AS whole_epochs,
        CASE WHEN tokens > 0 THEN floor(budget)::BIGINT % tokens ELSE 0 END AS rest FROM b3),
    ordered AS (SELECT base.*, whole_epochs, rest, sum(n_tokens) OVER (
        PARTITION BY domain, language, leaf
        ORDER BY md5('{seed}:' || whole_epochs || ':' || coalesce(doc_id::VARCHAR, 'null')), n_tokens
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM base JOIN plan USING (domain, language, leaf)),
    mixed AS (SELECT *, CASE WHEN n_tokens = 0 THEN 0
        ELSE whole_epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END END::BIGINT AS copies FROM ordered)"""


@query(
    "op8_mixing",
    f"WITH {mixture_sql('documents', mixing.SHARE, mixing.EPOCHS)} SELECT doc_id, domain, language, leaf, n_tokens, copies FROM mixed",
)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


@query("op6_decontamination")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op9_warc")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"))


@query("op10_html_region")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_region.extract(table(spark, sf_dir, "pages"))


@query("op2_secrets")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets(table(spark, sf_dir, "documents"))


@query("op5_token_counts")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_path(UNIGRAM))


@query("op1_licenses")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` has no paths: source / language / hundred of the id / id stands for one, and any file may license its directory."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws(
        "/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string")
    )
    return licenses.licences(docs.select("doc_id", path.alias("path"), "text"), named_only=False)


HARD_NEGATIVES_SQL = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
pairs AS (
    SELECT a.vec_id AS anchor_id, r.vec_id, r.label = a.label AS same, list_inner_product(a.q, r.q)::BIGINT AS score
    FROM whole a JOIN whole r ON r.vec_id != a.vec_id WHERE a.vec_id % 50 = 0),
own AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT own.anchor_id, positive_id, row_number() OVER (PARTITION BY own.anchor_id, positive_id ORDER BY score DESC, vec_id)::INT AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM own JOIN pairs ON pairs.anchor_id = own.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3"""


@query("op11_hard_negatives", HARD_NEGATIVES_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(vectors.withColumn("label", moved))


UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

COLLOCATIONS_SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
        regexp_extract_all(unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w
    FROM documents),
grams AS (
    {" UNION ALL ".join(f"SELECT lang, {k} AS k, w[i : i + {k - 1}] AS p FROM (SELECT lang, w, unnest(range(1, len(w) - {k - 2})) AS i FROM pieces)" for k in range(1, 5))}),
f AS (SELECT lang, k, p, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
cuts AS (SELECT lang, k, p, a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scored AS (
    SELECT cuts.lang, cuts.p, cuts.a, c, x.a AS l, y.a AS r, (2000000::HUGEINT * cuts.a // (x.a + y.a))::BIGINT AS score
    FROM cuts JOIN f x ON x.lang = cuts.lang AND x.p = cuts.p[1:c] JOIN f y ON y.lang = cuts.lang AND y.p = cuts.p[c + 1 :]
    QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.p ORDER BY score, c) = 1),
inner_parts AS (SELECT lang, a, k, p, unnest(range(2, k)) AS m FROM f WHERE k > 2),
held AS (SELECT lang, p[i : i + m - 1] AS p, max(a) AS most FROM (SELECT *, unnest(range(1, k - m + 2)) AS i FROM inner_parts) GROUP BY ALL),
kept AS (
    SELECT scored.*, array_to_string(scored.p, ' ') AS phrase FROM scored LEFT JOIN held ON held.lang = scored.lang AND held.p = scored.p
    WHERE most IS NULL OR 100 * most < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::INT AS rank, phrase, a, l, r, n, score
FROM kept JOIN totals USING (lang) QUALIFY rank <= 2000"""


@query("op12_collocations", COLLOCATIONS_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


SUBSTRINGS_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, s, w[s : s + 19] AS q FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM d)),
firsts AS (SELECT q, min({'doc': doc_id, 's': s}) AS f, count(*) AS c FROM windows GROUP BY q HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS pos FROM windows JOIN firsts USING (q) WHERE {'doc': doc_id, 's': s} > f),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d),
kept AS (
    SELECT doc_id, count(*) FILTER (WHERE gone.pos IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone.pos IS NULL) AS rest
    FROM words LEFT JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(rest, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""


@query("op13_substrings", SUBSTRINGS_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
