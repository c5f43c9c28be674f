"""Quality of documents: a classifier's evidence combined with what is known of host and path.

A document classifier over features of form gives each text a probability. Hosts and paths
are judged by all their documents: a host's posterior mean starts from the global mean, a
path's from its host's, each with a prior strength found from how much hosts (paths) really
differ (method of moments). Sparse sites so shrink toward their parents. A document's score
adds to its own log-odds how far its path's posterior lies from the global prior.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm import boosting
from sparkmart.llm.common import arrow_schema, held_out, learned, prepare, stored, text_of
from sparkmart.llm.textbytes import SPACE, chunks, doc_words, text_buffers

FEATURES = 9
_LINE = np.zeros(256, dtype=bool)
_LINE[[0x0A, 0x0D]] = True
_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "!#$%&*@^~=+<>{}"]] = True
_UPPER, _DIGIT = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
_UPPER[65:91], _DIGIT[48:58] = True, True
_BAR = np.zeros(256, dtype=bool)
_BAR[ord("|")] = True


@dataclass(frozen=True)
class Quality:
    #: The document classifier is fitted on about this many labelled rows at most.
    fit_rows: int = 20_000
    rounds: int = 40
    threshold: float = 0.5
    #: Prior strengths are kept within these bounds, in documents.
    weakest: float = 2.0
    strongest: float = 1e6


def form_features(column: pa.Array) -> np.ndarray:
    """Shares of symbols, capitals, digits and bars, of distinct words, of the commonest word and of distinct lines; lengths."""
    body, bounds = text_buffers(column)
    out = np.zeros((len(column), FEATURES))
    for lo, hi in chunks(bounds):
        words, first = doc_words(body, bounds[lo : hi + 1], SPACE)
        lines, line = doc_words(body, bounds[lo : hi + 1], _LINE)
        for r in range(lo, hi):
            text = body[bounds[r] : bounds[r + 1]]
            if not len(text):
                continue
            shares = [np.count_nonzero(kind[text]) / len(text) for kind in (_SYMBOL, _UPPER, _DIGIT, _BAR)]
            own, rows = words[first[r - lo] : first[r - lo + 1]], lines[line[r - lo] : line[r - lo + 1]]
            kinds, n = np.unique(own, return_counts=True)
            distinct, most = (len(kinds) / len(own), n.max() / len(own)) if len(own) else (0.0, 0.0)
            fresh = len(np.unique(rows)) / len(rows) if len(rows) else 0.0
            out[r] = *shares, distinct, most, fresh, np.log1p(len(own)), len(text) / max(1, len(own))
    return out


def document_evidence(docs: DataFrame, labels: DataFrame, p: Quality, host: Column, path: Column) -> DataFrame:
    """(doc_id, host, path, odds): log-odds of good quality from the text alone."""
    spark = prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of(F.col("text")).alias("text"), host.cast("string").alias("host"), path.cast("string").alias("path"))
    ddl = "doc_id long, host string, path string, features binary"
    schema = arrow_schema(ddl)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = form_features(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), pa.array([r.tobytes() for r in x], pa.binary())], schema=schema)

    seen = stored(rows.mapInArrow(work, ddl), "features")
    known = labels.where("quality in (0, 1) and doc_id is not null").where(learned(F.col("doc_id"), 3, 1))
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    share = min(1.0, p.fit_rows / max(1, known.count()))
    picked = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(int(share * 1_000_000))
    sample = seen.where(picked).select("doc_id", "features").join(known, "doc_id").orderBy("doc_id").select("features", "quality").collect()
    x = np.array([np.frombuffer(r["features"]) for r in sample]).reshape(-1, FEATURES)
    y = np.array([float(r["quality"]) for r in sample])
    trees = boosting.train(x, y, np.ones(len(y)), rounds=p.rounds) if len(set(y.tolist())) == 2 else None
    plain = 0.0 if not len(y) else float(np.clip(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)), -7, 7))
    model = spark.sparkContext.broadcast(trees)
    ddl = "doc_id long, host string, path string, odds double"
    out_schema = arrow_schema(ddl)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(3).to_pylist())).reshape(-1, FEATURES)
            odds = model.value.margin(x) if model.value else np.full(batch.num_rows, plain)
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.clip(odds, -12, 12))], schema=out_schema)

    return seen.mapInArrow(score, ddl)


def _moments(groups: DataFrame, p: Quality) -> tuple[float, float]:
    """(mean of all documents, prior strength in documents) from groups (n, total, squares).

    Between-group variance is what the spread of group means leaves beyond the noise of their
    sizes; the strength is within-group over between-group variance.
    """
    row = groups.agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("total"),
        F.sum("squares").alias("squares"),
        F.sum(F.col("total") * F.col("total") / F.col("n")).alias("between"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.count(F.lit(1)).alias("groups"),
    ).first()
    if not row["n"]:
        return 0.5, p.strongest
    n, mean = float(row["n"]), row["total"] / row["n"]
    within = max(row["squares"] - row["between"], 0.0) / max(1.0, n - row["groups"])
    spread = row["between"] - n * mean * mean
    scale = n - row["nn"] / n
    between = (spread - (row["groups"] - 1) * within) / scale if scale > 0 else 0.0
    strength = within / between if between > 0 else p.strongest
    return float(mean), float(min(max(strength, p.weakest), p.strongest))


def _logit(x: Column) -> Column:
    return F.log(x / (1 - x))


def quality_scores(docs: DataFrame, labels: DataFrame, host: Column, path: Column, p: Quality = Quality()) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, host_posterior, path_posterior, score, predicted.

    ``host`` and ``path`` are columns of ``docs``; a path belongs to its host. Learned from the rows of
    ``labels`` (doc_id, quality) whose id may be learned from (crc32 modulo 3 is not 1); an id labelled
    twice is good only if both say so.

    - Null host or path is a site of its own. Null and empty texts are scored by their empty form.
    - Without labels of both classes the classifier gives every text the same odds.
    - Sites are summed before any shuffle of documents, so a host with a third of all rows is no
      hot task. Repeated rows count each; other columns are ignored; an empty table gives no rows.
    """
    evidence = stored(document_evidence(docs, labels, p, host, path), "evidence")
    chance = 1 / (1 + F.exp(-F.col("odds")))
    sums = [F.count(F.lit(1)).alias("n"), F.sum(chance).alias("total"), F.sum(chance * chance).alias("squares")]
    paths = stored(evidence.groupBy("host", "path").agg(*sums), "paths")
    hosts = paths.groupBy("host").agg(*(F.sum(c).alias(c) for c in ("n", "total", "squares")))
    mean, host_strength = _moments(hosts, p)
    _, path_strength = _moments(paths, p)
    safe = lambda c: F.least(F.greatest(c, F.lit(1e-6)), F.lit(1 - 1e-6))
    hosts = hosts.select(F.col("host").alias("h"), safe((F.lit(mean * host_strength) + F.col("total")) / (host_strength + F.col("n"))).alias("host_posterior"))
    paths = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).select(
        F.col("host").alias("h"),
        F.col("path").alias("q"),
        "host_posterior",
        safe((F.col("host_posterior") * path_strength + F.col("total")) / (path_strength + F.col("n"))).alias("path_posterior"),
    )
    out = evidence.join(paths, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("q")))
    prior = float(np.clip(mean, 1e-6, 1 - 1e-6))
    odds = F.col("odds") + _logit(F.col("path_posterior")) - F.lit(float(np.log(prior / (1 - prior))))
    score = (1 / (1 + F.exp(-odds))).alias("score")
    out = out.select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "host_posterior", "path_posterior", score)
    return out.withColumn("predicted", (F.col("score") >= p.threshold).cast("int"))
