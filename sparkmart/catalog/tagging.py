"""Sampling, keyword labels, requests and answers over the documents."""

from __future__ import annotations

import json
import re

from pyspark.sql import functions as F

from sparkmart.catalog.inputs import oracle_inputs, spark_input
from sparkmart.functions.text import COMPLAINT_TYPES, LEXICON, SENTIMENTS
from sparkmart.operators.sampling import stratified_sample
from sparkmart.plans import tagging
from sparkmart.session import work_dir

SAMPLE = 200


def _reviews(spark, sf_dir):
    return spark_input(spark, sf_dir, "text_reviews")


def sample(spark, sf_dir):
    text = F.col("review_text")
    picked = stratified_sample(
        _reviews(spark, sf_dir), "review_id", "rating", SAMPLE, text.isNotNull() & (F.length(text) >= tagging.MIN_TEXT)
    )
    return picked.select("review_id", "rating", "rn", "brand_id")


def keyword_tag(spark, sf_dir):
    """Labels of every document, from its whole text."""
    tagged = tagging.keyword_tags(_reviews(spark, sf_dir), text="review_text")
    return tagged.select("review_id", "rating", "sentiment", "complaint_type", "is_complaint", "evidence")


def _sampled(spark, sf_dir, tags):
    return tagging.sample_reviews(_reviews(spark, sf_dir), "keyword_baseline", tags, SAMPLE)


def _no_tags(spark):
    return spark.createDataFrame([], tagging.TAGS)


def _tags(todo):
    tagged_at = F.lit("2002-03-01 00:00:00").cast("timestamp")
    return tagging.tag_rows(tagging.keyword_tags(todo), "keyword_baseline", "regex-v1", tagged_at)


def tag_rows(spark, sf_dir):
    return _tags(_sampled(spark, sf_dir, _no_tags(spark))).drop("tagged_at")


def tag_resume(spark, sf_dir):
    """A run that stopped after ten reviews per star, then a full one."""
    path = f"{work_dir(spark, 'tags')}/review_tags"
    tagging.append_tags(spark, path, _tags(_sampled(spark, sf_dir, _no_tags(spark)).where("rn <= 10")))
    for _ in range(2):
        todo = _sampled(spark, sf_dir, tagging.read_tags(spark, path))
        tagging.append_tags(spark, path, _tags(todo))
    return tagging.read_tags(spark, path).drop("tagged_at")


def _requests(spark, sf_dir):
    reviews = _reviews(spark, sf_dir).withColumnRenamed("review_text", "text")
    return tagging.request_batches(reviews, order="review_id")


def label_request_batches(spark, sf_dir):
    """Requests for every document, each with its whole text."""
    return _requests(spark, sf_dir).select(
        "batch", F.array_join("review_ids", ",").alias("review_ids"), F.md5("body").alias("body_md5")
    )


def _answer(key, i, kinds):
    number = key.cast("long")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by % len(values) + 1).cast("int"))
    return F.struct(
        F.concat(F.lit("r"), i.cast("string")).alias("id"),
        F.when(number % 10 == 0, "great").otherwise(pick(SENTIMENTS, number)).alias("sentiment"),
        pick(kinds, number).alias("complaint_type"),
        F.concat(F.lit("quote "), key).alias("evidence"),
    )


def label_response_parse(spark, sf_dir):
    """Answers with gaps, wrong labels and a first, outdated answer to every review."""
    requests = _requests(spark, sf_dir)
    answers = F.transform("review_ids", lambda key, i: _answer(key, i, COMPLAINT_TYPES))
    outdated = F.transform("review_ids", lambda key, i: _answer(key, i, ["none"]))
    every_ninth = lambda a: F.substring_index(a["evidence"], " ", -1).cast("long") % 9 != 0
    answered = requests.select(
        "batch",
        "review_ids",
        F.to_json(F.concat(F.filter(outdated, every_ninth), F.filter(answers, every_ninth))).alias("response"),
    )
    return tagging.parse_responses(answered).drop("batch")


def _length_labeler(prompt: str) -> str:
    """Stands in for a model: calls a text a complaint by its length, and quotes the length."""
    items = re.findall(r"^\[r(\d+)\] (.*?)(?=\n\[r\d+\] |\Z)", prompt.split("\nInput:\n", 1)[1], re.S | re.M)
    return json.dumps(
        [
            {
                "id": f"r{i}",
                "sentiment": "neutral",
                "complaint_type": "texture" if len(text) % 2 else "none",
                "evidence": str(len(text)),
            }
            for i, text in items
        ]
    )


def label_documents(spark, sf_dir):
    """Every document labelled through requests, in two rounds of two runs; the second run finds nothing to ask."""
    base = work_dir(spark, "labels")
    todo = _reviews(spark, sf_dir).select("review_id", "rating", F.col("review_text").alias("text"))
    todo = todo.where("text is not null").withColumn("rn", F.col("review_id").cast("long"))
    for _ in range(2):
        tagging.label_reviews(
            spark, todo, f"{base}/tags", f"{base}/outcomes", _length_labeler, "outside", "length", workers=8, per_round=400, pause=0
        )
    return tagging.read_tags(spark, f"{base}/tags").drop("tagged_at")


QUERIES = {
    "label_documents": label_documents,
    "stratified_sample": sample,
    "keyword_tag": keyword_tag,
    "tag_rows": tag_rows,
    "tag_resume": tag_resume,
    "label_request_batches": label_request_batches,
    "label_response_parse": label_response_parse,
}


def keyword_sql(lexicon) -> str:
    """Common table expression ``{name}``: the rows of ``{source}`` with labels."""
    quoted = [(kind, p.replace("'", "''").replace("{", "{{").replace("}", "}}")) for kind, p in lexicon]
    kinds = " ".join(f"when regexp_matches(lower(text), '{p}') then '{k}'" for k, p in quoted)
    quotes = " ".join(f"when regexp_matches(lower(text), '{p}') then regexp_extract(lower(text), '{p}', 0)" for _, p in quoted)
    return f"""{{name}} as (
      select *, case when rating >= 4 then 'positive' when rating <= 2 then 'negative' else 'neutral' end as sentiment,
        case when rating >= 4 then 'none' {kinds} when rating <= 2 then 'other' else 'none' end as complaint_type,
        case when rating >= 4 then '' {quotes} else '' end as quote
      from {{source}})"""


KEYWORD_TAGS = keyword_sql(LEXICON)
_REVIEWS = oracle_inputs("text_reviews")
# The sample by its rule: a review is in if fewer than the quota of its stars come before it.
_RANKED = f"""{_REVIEWS},
  eligible as (
    select r.*, concat(md5(concat(review_id, '42')), review_id) as draw from text_reviews r where length(review_text) > 19),
  placed as (select e.*, count(*) over (partition by rating order by draw) as rn from eligible e),
  sampled as (from placed where rn <= {SAMPLE} / 5)"""
_SAMPLE_TAGS = f"""{_RANKED},
  whole_texts as (
    select review_id, rating, concat(case when review_title is not null then review_title || '. ' end, review_text) as text
    from sampled),
  {KEYWORD_TAGS.format(source='whole_texts', name='labelled')}
  select review_id, sentiment, complaint_type, complaint_type != 'none' as is_complaint, quote as evidence,
    'regex-v1' as model, 'keyword_baseline' as labeler
  from labelled"""
_TYPES = ", ".join(f"'{t}'" for t in COMPLAINT_TYPES)

ORACLES = {
    "label_documents": f"""{_REVIEWS}
      select review_id, 'outside' as labeler, 'length' as model, 'neutral' as sentiment,
        case length(review_text) % 2 when 1 then 'texture' else 'none' end as complaint_type,
        length(review_text) % 2 = 1 as is_complaint, cast(length(review_text) as varchar) as evidence
      from text_reviews where review_text is not null""",
    "stratified_sample": f"{_RANKED} select review_id, rating, cast(rn as integer) as rn, brand_id from sampled",
    "keyword_tag": f"""{_REVIEWS},
      texts as (select review_id, rating, review_text as text from text_reviews),
      {KEYWORD_TAGS.format(source='texts', name='labelled')}
      select review_id, rating, sentiment, complaint_type, complaint_type <> 'none' as is_complaint, quote as evidence
      from labelled""",
    "tag_rows": _SAMPLE_TAGS,
    "tag_resume": _SAMPLE_TAGS,
    "label_request_batches": f"""{_REVIEWS},
      numbered as (
        select *, left(md5(review_id), 2) as shard,
          row_number() over (partition by rating, left(md5(review_id), 2) order by review_id) - 1 as idx
        from text_reviews)
      select rating || '-' || shard || '-' || (idx // 20) as batch,
        string_agg(review_id, ',' order by idx) as review_ids,
        md5(string_agg('[r' || (idx % 20) || '] ' || review_text, chr(10) order by idx)) as body_md5
      from numbered group by rating, shard, idx // 20""",
    "label_response_parse": f"""{_REVIEWS},
      answers as (
        select review_id, cast(review_id as bigint) as number from text_reviews where cast(review_id as bigint) % 9 <> 0),
      labelled as (
        select review_id,
          case when number % 10 = 0 then 'great' else (['positive', 'neutral', 'negative'])[number % 3 + 1] end as sentiment,
          ([{_TYPES}])[number % 8 + 1] as complaint_type, 'quote ' || review_id as evidence
        from answers)
      select *, case when sentiment = 'great' then 'sentiment' end as reject from labelled""",
}
