"""The registered queries of the subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.llm import (
    exact_dedup,
    hash_forest,
    html_text,
    language,
    mixing,
    near_dedup,
    packing,
    pieces,
    quality,
    resampling,
    spelling,
    toxicity,
    url_filter,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), near_dedup.NearDedup(similarity=85))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents have no url: source stands in for the host, lang for the path."""
    docs = _table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, _table(spark, sf_dir, "labels"), host=F.col("source"), path=F.col("lang"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(_table(spark, sf_dir, "pages"))


MIXTURE = mixing.Mixture(
    {
        "source": {"src0": 0.25, "src1": 0.06, mixing.OTHER: 0.69},
        "lang": {"en": 0.55, "de": 0.17, "fr": 0.16, "es": 0.12, mixing.OTHER: 0.01},
        "topic": {"prose": 0.9, "license": 0.04, "table": 0.03, mixing.OTHER: 0.03},
    }
)


def mixture_columns() -> dict:
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"))}


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixing_report(_table(spark, sf_dir, "documents"), mixture_columns(), MIXTURE)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language.identify_languages(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score", F.concat_ws(" ", "languages").alias("languages"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return hash_forest.nearest_neighbours(vectors, vectors.where("vec_id % 20 = 0"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = pieces.encode_texts(_table(spark, sf_dir, "documents"), piece_model_path())
    decoded = pieces.decode_ids(encoded, piece_model_path())
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"), spelling.Spelling(slip=31))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_quality": op3_quality,
    "op4_toxicity": op4_toxicity,
    "op5_html_text": op5_html_text,
    "op6_url_filter": op6_url_filter,
    "op7_mixing": op7_mixing,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_neighbours": op10_neighbours,
    "op11_resampling": op11_resampling,
    "op12_pieces": op12_pieces,
    "op13_spelling": op13_spelling,
}

# crc32 in SQL: the table of the 256 byte values, and the register carried over the bytes of a text.
CRC_TABLE = """crc_table as (
            select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc_of)"""
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sql_crc32(column: str) -> str:
    byte = f"('0x' || substr(hex({column}), 2 * i - 1, 2))::bigint"
    return f"""xor(list_reduce(list_prepend(4294967295, list_transform(range(1, strlen({column}) + 1), lambda i: {byte})),
                lambda c, b: xor(c >> 8, crc_of[(xor(c, b) & 255) + 1])), 4294967295)"""


ORACLES: dict[str, str] = {
    "op11_resampling": f"""
        with {CRC_TABLE},
        words as (
            select doc_id, true as source, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word from documents
            union all
            select null, false, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) from benchmark),
        kinds as (select word, {sql_crc32("word")} % 10000 as bucket from (select distinct word from words), crc_table),
        counted as (
            select bucket, count(*) filter (source) as s, count(*) filter (not source) as t from words join kinds using (word) group by bucket),
        totals as (select coalesce(sum(s), 0) as s_all, coalesce(sum(t), 0) as t_all from counted),
        gains as (
            select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000) / ((s + 1)::double * (t_all + 10000))))::bigint as gain from counted, totals),
        weighed as (
            select doc_id, count(*) as n_features, sum(gain)::bigint as total from words join kinds using (word) join gains using (bucket) where source group by doc_id),
        scored as (
            select d.doc_id, coalesce(n_features, 0) as n_features,
                   coalesce((total - ((total % n_features) + n_features) % n_features) // n_features, 0)::bigint as weight,
                   (('0x' || substr(sha256('2024:' || d.doc_id), 1, 8))::bigint + 0.5::double) / 4294967296 as u
            from documents d left join weighed w on d.doc_id = w.doc_id),
        placed as (
            select doc_id, n_features, weight, weight + floor(-1000 * ln(-ln(u)))::bigint as score,
                   case when n_features >= 20 then row_number() over (partition by n_features >= 20 order by weight + floor(-1000 * ln(-ln(u))) desc, doc_id) end as place
            from scored)
        select doc_id, n_features, weight, score,
               case when place <= (10 * (select count(*) from scored where n_features >= 20)) // 100 then place end as rank
        from placed""",
    "op13_spelling": f"""
        with {CRC_TABLE},
        runs as (select doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[a-z\u00C0-\u00FF]+')) as run from documents),
        counted as (select coalesce(doc_id::varchar, '') || ':' || run as line, run, count(*) as n from runs where length(run) >= 7 group by all),
        coded as (select run, n, {sql_crc32("line")} as h from counted, crc_table),
        slipped as (
            select case when h % 31 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word, n
            from coded),
        words as (select word, sum(n)::bigint as n from slipped where length(word) >= 7 group by word having sum(n) >= 2),
        holes as (
            select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest
            from (select word, n, unnest(range(1, length(word) + 1)) as i from words)),
        pairs as (
            select a.word, b.word as near, b.n from holes a join holes b on a.rest = b.rest and a.i = b.i and a.word <> b.word
            union select a.word, b.word, b.n from holes a join words b on a.rest = b.word
            union select b.word, a.word, a.n from holes a join words b on a.rest = b.word),
        clusters as (select word, count(*) as n_near, arg_min(near, (-n, near)) as near, max(n) as near_n from pairs group by word),
        judged as (
            select w.word, case when near_n >= 10 * w.n then near end as form, w.n, coalesce(n_near, 0) as n_near,
                   case when near_n >= 10 * w.n then near_n end as form_n
            from words w left join clusters c using (word)),
        steps as (
            with recursive walk as (
                select word, word as root from judged
                union all
                select w.word, j.form from walk w join judged j on w.root = j.word where j.form is not null)
            select word, root from walk)
        select j.word, j.form, s.root, j.n, j.n_near, j.form_n
        from judged j join (select s.word, s.root from steps s join judged k on s.root = k.word where k.form is null) s on j.word = s.word""",
    "op2_exact_dedup": """
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               coalesce(doc_id = max(doc_id) over g, max(doc_id) over g is null) as kept,
               sha256(coalesce(text, '')) as text_sha256
        from documents window g as (partition by coalesce(text, ''))""",
    "op6_url_filter": r"""
        with parts as (
            select page_id,
                   case when contains(url, '://')
                        then translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                        else '' end as host,
                   case when contains(url, '://') then regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) else '' end as path
            from pages),
        rules(verdict, rule_host, rule_path) as (
            values ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
                   ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        fits as (
            select p.*, r.rule_host || r.rule_path as rule, r.verdict,
                   row_number() over (partition by p.page_id order by r.rule_host is null, length(r.rule_host) desc, length(r.rule_path) desc) as place
            from parts p left join rules r
              on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where place = 1""",
}
