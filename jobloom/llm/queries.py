"""Registered queries of the operators, over whole tables, with DuckDB twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from jobloom.llm import chat_format, katz, mixing, near_duplicates, packing, quality_rules, rule_ensemble, sharding, substring_dedup, token_counts, vector_codes, vector_search, whitening

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@register("op7_cost_packing")
def cost_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_tokenizer())


@register("op4_token_counts")
def linear_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    pieces = token_counts.sentence_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), pieces)


@register("op5_efraimidis_spirakis_mix")
def weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("row")


@register("op6_hilbert_shards")
def curve_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.hilbert_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve",
    )


@register("op10_robust_outliers")
def robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents")).drop("row", "lang", "source", "mark")


_TOP_K = """
with vectors as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
  from vectors q join vectors c on q.vec_id <> c.vec_id and len(q.v) = len(c.v)
  where q.vec_id % 50 = 0
)
select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score
from scored qualify row_number() over (partition by query_id order by score desc, vec_id) <= 5
"""


@register("op3_va_file_top_k", _TOP_K)
def va_file_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@register("op8_rule_ensemble")
def rule_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    scored = rule_ensemble.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


_SUBSTRING = """
with words as materialized (
  select row_number() over () as r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents
), starts as (
  select r, unnest(range(1, len(w) - 33)) as s, w from words where len(w) >= 35
), marks as (
  select r, s, array_to_string(w[s:s + 34], ' ') as mark from starts
), again as (
  select r, s from marks qualify count(*) over (partition by mark) > 1
), gone as (
  select distinct r, unnest(range(s, s + 35)) as place from again
), places as (
  select r, list(place) as gone from gone group by r
)
select doc_id, len(w)::bigint as n_words, coalesce(len(gone), 0)::bigint as n_removed,
  sha256(array_to_string(case when gone is null then w else list_filter(w, lambda x, i: not list_contains(gone, i)) end, ' ')) as kept_sha256
from words left join places using (r)
"""


@register("op1_fixed_block_substrings", _SUBSTRING)
def fixed_block_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substring_dedup.cut_repeats(table(spark, sf_dir, "documents"))
    return cut.select(F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


_NEAR = """
with recursive words as materialized (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') as w from documents
), shingles as materialized (
  select distinct doc_id, case when len(w) < 5 then array_to_string(w, ' ') else array_to_string(w[s:s + 4], ' ') end as shingle
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) as s from words where len(w) > 0)
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), common as (
  select a.doc_id as a, b.doc_id as b, count(*) as c from shingles a join shingles b using (shingle) where a.doc_id <> b.doc_id group by all
), links as materialized (
  select a, b, p.n = c and q.n = c as equal from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b where 9 * c >= 4 * (p.n + q.n)
), reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select reach.doc_id, links.b from reach join links on links.a = reach.other
)
select doc_id, (select min(other) from reach r where r.doc_id = d.doc_id) as class_id,
  least(doc_id, coalesce((select min(b) from links where a = doc_id and equal), doc_id)) as copy_of,
  (select count(*) from links where a = doc_id) as n_links
from documents d
"""


@register("op9_minhash_forest_join", _NEAR)
def minhash_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.join(table(spark, sf_dir, "documents")).drop("row", "first")


@register("op2_katz_scores")
def katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False))
    scored = katz.score(table(spark, sf_dir, "documents"), ~held_out)
    return scored.select(
        F.col("row.doc_id").alias("doc_id"), (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def _codes_sql(parts: int, entries: int, rounds: int) -> str:
    """The same rounds by comparing every part with every entry; doubles hold all distances exactly."""
    steps = [
        """vectors as (
  select vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
)""",
        f"""pieces as materialized (
  select vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] as q from vectors, range({parts}) r(p)
)""",
        f"""book0 as materialized (
  select p, entry, q as c from (select p, q, row_number() over (partition by p order by vec_id) - 1 as entry from pieces) where entry < {entries}
)""",
    ]
    for n in range(rounds + 1):
        steps.append(f"""near{n} as materialized (
  select vec_id, label, p, q, unnest(best) from (
    select vec_id, any_value(label) as label, p, any_value(q) as q,
      min({{'d': list_dot_product(q, q) + list_dot_product(c, c) - 2 * list_dot_product(q, c), 'entry': entry}}) as best
    from pieces join book{n} using (p) group by vec_id, p)
)""")
        if n < rounds:
            steps.append(f"""mean{n} as (
  select p, entry, list(m order by place) as c from (
    select p, entry, place, floor(sum(x) / count(*)) as m from (select p, entry, unnest(q) as x, generate_subscripts(q, 1) as place from near{n})
    group by all) group by p, entry
), book{n + 1} as materialized (
  select p, entry, coalesce(m.c, b.c) as c from book{n} b left join mean{n} m using (p, entry)
)""")
    return f"""
with {", ".join(steps)}, coded as (
  select vec_id, any_value(label) as label, string_agg(printf('%02x', entry), '' order by p) as code, sum(d)::bigint as error
  from near{rounds} group by vec_id
), hashed as (
  select sha256(string_agg(array_to_string(list_transform(c, lambda x: x::bigint), ','), ',' order by p, entry)) as h from book{rounds}
)
select vec_id, label, code, error, (sum(error) over (partition by label))::bigint as label_error, h as codebooks_sha256 from coded, hashed
"""


@register("op11_gnat_codes", _codes_sql(vector_codes.PARTS, vector_codes.ENTRIES, vector_codes.ROUNDS))
def gnat_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


@register("op13_exact_whitening")
def exact_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whitening.whiten(table(spark, sf_dir, "embeddings"))
    return white.withColumn("deviation", F.col("deviation").cast("long"))


# A conversation of its own whose texts look like marks.
_MARKS = r"\### Assistant: </turn> ok"


@register("op12_budgeted_chat_windows")
def budgeted_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations")
    more = spark.createDataFrame([(-7, 0, "user", _MARKS), (-7, 1, "assistant", _MARKS)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_chats(given.unionByName(more), word_tokenizer()))
