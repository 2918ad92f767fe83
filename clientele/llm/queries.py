"""Named queries of this subpackage and their reference SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm import (
    ann,
    chat,
    embedding_dedup,
    manifest,
    mixing,
    packing,
    pii,
    quality,
    simhash,
    token_counts,
    topk,
    url_filter,
    whitening,
)
from clientele.llm.common import UPPER, table, word_count
from clientele.sources.scratch import materialise

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
REFERENCE_SQL: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


# --- quality ---------------------------------------------------------------


@query
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    points = materialise(
        docs.select("doc_id", quality.text_statistics(F.col("text")).alias("statistics"))
    )
    model = quality.fit(points, table(spark, folder, "labels"))
    return points.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        quality.score(F.col("statistics"), model).alias("score"),
    ).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


# --- chat formatting -------------------------------------------------------

PROBE = "\\### Assistant: </turn> ok"


@query
def op2_chat_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of what is read back from the formatted windows."""
    probe = spark.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)],
        "conv_id long, turn long, role string, text string",
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    windows = chat.chat_windows(turns.unionByName(probe))
    read = windows.select(
        "conv_id",
        "window",
        F.expr("size(loss)").alias("targets"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.slice(chat.read_turns(F.col("formatted")), F.col("context_turns") + 1, 2147483647).alias(
            "turns"
        ),
        F.array_join(chat.read_loss(F.col("formatted"), F.col("loss")), "").alias("loss"),
    ).select(
        "conv_id",
        "formatted_chars",
        F.size("turns").cast("long").alias("n_turns"),
        F.struct(
            "window",
            F.array_join(
                F.transform(
                    "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
                ),
                "",
            ).alias("turns"),
            "loss",
        ).alias("part"),
    )
    digest = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    return (
        read.groupBy("conv_id")
        .agg(
            F.sum("n_turns").alias("n_turns"),
            F.sum(F.length("part.loss")).alias("loss_chars"),
            F.sum("formatted_chars").alias("formatted_chars"),
            F.array_sort(F.collect_list("part")).alias("parts"),
        )
        .select(
            "conv_id",
            "n_turns",
            F.sha2(digest("turns").cast("binary"), 256).alias("turns_sha256"),
            "loss_chars",
            F.sha2(digest("loss").cast("binary"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


# --- embedding near-duplicates ---------------------------------------------


@query
def op3_embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.embedding_duplicates(table(spark, folder, "embeddings"))


# --- packing ---------------------------------------------------------------


@query
def op4_cost_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    packed = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


# --- personal data ---------------------------------------------------------


@query
def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of what the rules find, and all spans."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = docs.select("doc_id", pii.personal_data(F.col("text"), pii.train_on(docs)).alias("all"))
    written = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    base = F.filter("all", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[
            F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")  # noqa: B023
            for kind in pii.KINDS
        ],
        F.sha2(written(base).cast("binary"), 256).alias("base_sha256"),
        written("all").alias("spans"),
    )


# --- token counts ----------------------------------------------------------


@query
def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_tokens")


# --- URL filters -----------------------------------------------------------

URL_RULES = (
    url_filter.Rule("allow", "com", "/"),
    url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"),
    url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
)


@query
def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_filter.judge_urls(pages, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _url_sql() -> str:
    lower = f"translate(url, '{UPPER}', '{UPPER.lower()}')"
    ladder = lambda value: " ".join(
        f"WHEN (host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        f" THEN '{value(r)}'"
        for r in sorted(URL_RULES, key=lambda r: -len(r.text))
    )
    weight = " + ".join(
        f"{w} * regexp_matches(low, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::INT"
        for t, w in url_filter.VOCABULARY.items()
    )
    return f"""
    WITH parts AS (
      SELECT page_id, coalesce({lower}, '') AS low,
        coalesce(translate(regexp_extract(url, '{url_filter.AUTHORITY}', 1), '{UPPER}', '{UPPER.lower()}'), '') AS host,
        coalesce(regexp_extract(url, '{url_filter.PATH}', 1), '') AS path
      FROM pages)
    SELECT page_id, host, path,
      CASE {ladder(lambda r: r.text)} END AS rule,
      CASE {ladder(lambda r: r.verdict)}
        WHEN {weight} >= {url_filter.LIMIT} THEN 'block' ELSE 'allow' END AS verdict
    FROM parts
    """


REFERENCE_SQL["op7_url_filter"] = _url_sql()


# --- SimHash near-duplicates ------------------------------------------------


@query
def op8_simhash_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents"))
    return found.withColumn("fingerprint", F.lpad(F.lower(F.hex("fingerprint")), 16, "0"))


# --- nearest neighbours ----------------------------------------------------


@query
def op9_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return ann.nearest(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0)


# --- mixing ----------------------------------------------------------------


@query
def op10_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    sizes = materialise(docs.select("doc_id", "source", word_count(F.col("text")).alias("size")))
    return mixing.systematic_copies(sizes).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


REFERENCE_SQL["op10_source_mix"] = r"""
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
named AS (
  SELECT source, sum(size)::BIGINT AS source_size, 3 * sum(size)::BIGINT AS most,
    (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) AS turn
  FROM sized GROUP BY source),
weighed AS (SELECT *, turn % 3 + 1 AS weight FROM named),
room AS (
  SELECT *, sum(source_size) OVER () AS words, sum(weight) OVER () AS weights,
    coalesce(sum(most) OVER fore, 0) AS above, coalesce(sum(weight) OVER fore, 0) AS gone
  FROM weighed
  WINDOW fore AS (ORDER BY most / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
filled AS (
  SELECT *, (words - above) * weight > most::HUGEINT * (weights - gone) AS full_ FROM room),
shared AS (
  SELECT source, source_size,
    CASE WHEN full_ THEN most::DOUBLE
      ELSE ((words - sum(CASE WHEN full_ THEN most ELSE 0 END) OVER ()) * weight)::DOUBLE
         / (weights - sum(CASE WHEN full_ THEN weight ELSE 0 END) OVER ())::DOUBLE END AS target,
    ('0x' || substr(md5(coalesce(source, chr(0)) || '|0'), 1, 5))::INT / 1048576.0::DOUBLE AS u
  FROM filled),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size DESC, doc_id) - 1 AS r FROM sized),
rated AS (
  SELECT r.doc_id, r.size, s.source_size, s.target, s.u, r.r,
    CASE WHEN s.source_size > 0 THEN s.target / s.source_size::DOUBLE ELSE 0.0::DOUBLE END AS rate
  FROM ranked r JOIN shared s ON r.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
  (size * (floor((r + 1)::DOUBLE * rate + u) - floor(r::DOUBLE * rate + u)))::BIGINT AS taken
FROM rated
"""


# --- exact search ----------------------------------------------------------


@query
def op11_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


REFERENCE_SQL["op11_exact_top_k"] = """
WITH kept AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, vec_id, score,
    row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id)::INT AS rank
  FROM (
    SELECT q.vec_id AS query_id, q.x AS asked, c.vec_id,
      coalesce(list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])), 0)::BIGINT AS score
    FROM kept q JOIN kept c ON len(q.x) = len(c.x) AND (q.vec_id <> c.vec_id OR q.x <> c.x)
    WHERE q.vec_id % 50 = 0))
WHERE rank <= 5
"""


# --- manifest --------------------------------------------------------------


@query
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """The manifest of all documents, and what the tampered ones lead to."""
    docs = table(spark, folder, "documents")
    return manifest.manifest(docs, manifest.lowered(F.col("text"), F.col("doc_id")))


def _manifest_sql() -> str:
    written = lambda value: (
        f"coalesce(strlen(({value})::VARCHAR) || ':' || ({value})::VARCHAR, '-')"
    )
    leaf = lambda text: "sha256(" + " || ".join(
        written(text if f == "text" else f) for f in manifest.FIELDS
    ) + ")"
    tree = lambda name, leaves: f"""
    {name} AS (
      SELECT scope, 0 AS level, r AS idx, digest, total AS n FROM {leaves}
      UNION ALL
      SELECT scope, level + 1, idx // 8, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 7) // 8
      FROM {name} WHERE n > 1 GROUP BY scope, level, idx // 8)"""  # noqa: E731
    ways = lambda name, leaves: f"""
      SELECT l.scope, l.r, t.level,
        coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx < (l.r >> (3 * t.level))), '') AS before,
        coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx > (l.r >> (3 * t.level))), '') AS after
      FROM {leaves} l JOIN {name} t ON t.scope = l.scope AND t.n > 1
        AND t.idx // 8 = (l.r >> (3 * t.level)) // 8
      GROUP BY l.scope, l.r, t.level"""  # noqa: E731
    path = lambda source: f"""
      SELECT scope, r, list(before || '|' || after ORDER BY level) AS path,
        string_agg(before || after, '' ORDER BY level) AS siblings
      FROM ({source}) GROUP BY scope, r"""  # noqa: E731
    bits = ", ".join(["-1"] * 8)
    return f"""
    WITH RECURSIVE hashed AS (
      SELECT doc_id, coalesce('+' || lang, '') AS scope, {leaf('text')} AS digest,
        CASE WHEN doc_id IS NOT NULL AND checksum % 3 = 0 AND text IS NOT NULL
          THEN {leaf(f"translate(text, '{UPPER}', '{UPPER.lower()}')")} END AS changed
      FROM (
        SELECT *, xor(4294967295, list_reduce(
          list_concat([4294967295::BIGINT], flatten(list_transform(
            string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, {bits}]))),
          lambda crc, op: CASE WHEN op >= 0 THEN xor(crc, op)
            ELSE xor(crc >> 1, (crc & 1) * 3988292384) END)) AS checksum
        FROM documents)),
    leaves AS (
      SELECT *, row_number() OVER (PARTITION BY scope ORDER BY doc_id NULLS FIRST, digest) - 1 AS r,
        count(*) OVER (PARTITION BY scope) AS total
      FROM hashed),
    {tree('nodes', 'leaves')},
    subroots AS (
      SELECT '' AS scope, scope AS own, digest, row_number() OVER (ORDER BY scope) - 1 AS r,
        count(*) OVER () AS total
      FROM nodes WHERE n = 1),
    {tree('upper_nodes', 'subroots')},
    paths AS ({path(ways('nodes', 'leaves'))}),
    upper_paths AS ({path(ways('upper_nodes', 'subroots'))}),
    proven AS (
      SELECT l.doc_id, l.digest AS leaf, l.changed, s.digest AS subroot, t.digest AS root,
        list_concat(coalesce(p.path, []), coalesce(u.path, [])) AS path,
        coalesce(p.siblings, '') || coalesce(u.siblings, '') AS siblings
      FROM leaves l JOIN subroots s ON s.own = l.scope
        JOIN (SELECT digest FROM upper_nodes WHERE n = 1) t ON true
        LEFT JOIN paths p ON p.scope = l.scope AND p.r = l.r
        LEFT JOIN upper_paths u ON u.r = s.r),
    folded AS (
      SELECT *, list_reduce(list_concat([coalesce(changed, leaf)], path),
        lambda digest, way: sha256(split_part(way, '|', 1) || digest || split_part(way, '|', 2))) AS folded_root
      FROM proven)
    SELECT doc_id, leaf, subroot, root, sha256(siblings) AS proof_sha256, folded_root, folded_root = root AS verified
    FROM folded
    """


REFERENCE_SQL["op12_merkle_manifest"] = _manifest_sql()


# --- whitening -------------------------------------------------------------


@query
def op13_whitened_embeddings(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings"))
