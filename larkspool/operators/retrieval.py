"""Lexical and vector retrieval over chunks, and the metrics and reports that compare two arms."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ..functions.text import tokens
from ..scratch import written
from ..session import ship_package

K1, B = 1.5, 0.75
#: Terms of all queries together, and targets, up to these many are sent to every task; more of them are joined by shuffling.
MOST_TERMS, MOST_TARGETS = 500_000, 500_000
#: Query vectors that are sent to every task at once; more are searched block by block.  Rows that are compared at a time.
QUERY_BLOCK, ROW_BLOCK = 2_000, 2_000
#: Rows whose words are counted at a time, and cells of the matrices in which documents are scored.
COUNT_BLOCK, CELLS = 1_000, 4_000_000
METRICS = ("hit", "recall", "mrr", "ndcg")


def query_terms(queries: DataFrame) -> DataFrame:
    """query_id, term and how often the query has it, from queries(query_id, question)."""
    return queries.select("query_id", F.explode(tokens(F.col("question"))).alias("term")).groupBy("query_id", "term").agg(F.count("*").alias("times"))


def tokenised(corpus: DataFrame) -> DataFrame:
    """``corpus`` with its text as ``words`` and their number as ``doc_length``, written once for all that reads it.

    Documents have an ``arm``, or the ``arms`` that they are in, as those that several arms share are read only once.
    """
    arms = F.col("arms") if "arms" in corpus.columns else F.array("arm")
    rows = corpus.withColumns({"arms": arms, "words": tokens(F.col("text"))}).drop("arm", "text")
    return written(rows.withColumn("doc_length", F.size("words")), "retrieval_words")


def postings(corpus: DataFrame, terms: DataFrame) -> DataFrame:
    """arm, doc, doc_length, term and its frequency, for the wanted ``terms(term)`` only; ``corpus`` is ``tokenised``.

    Other words are dropped before anything is shuffled, and a document's words are counted where they are.
    """
    wanted = terms.select("term").distinct()
    small = wanted.count() <= MOST_TERMS
    words = corpus.select("arms", "doc", "doc_length", F.explode("words").alias("term"))
    counted = words.join(F.broadcast(wanted) if small else wanted, "term", "left_semi").groupBy("arms", "doc", "doc_length", "term").agg(F.count("*").alias("tf"))
    return counted.select(F.explode("arms").alias("arm"), "doc", "doc_length", "term", "tf")


def corpus_statistics(corpus: DataFrame) -> DataFrame:
    """Documents and their mean length for each arm of a ``tokenised`` corpus."""
    return corpus.select(F.explode("arms").alias("arm"), "doc_length").groupBy("arm").agg(F.count("*").alias("n_docs"), F.avg("doc_length").alias("mean_length"))


def idf(found: DataFrame, statistics: DataFrame) -> DataFrame:
    """Inverse document frequency of each term in each arm."""
    return _idf(found.groupBy("arm", "term").agg(F.count("*").alias("df")), statistics)


def _idf(df: DataFrame, statistics: DataFrame) -> DataFrame:
    value = F.log(1 + (F.col("n_docs") - F.col("df") + F.lit(0.5)) / (F.col("df") + F.lit(0.5)))
    return df.join(F.broadcast(statistics), "arm").select("arm", "term", "df", value.alias("idf"))


def prepared(corpus: DataFrame, queries: DataFrame) -> DataFrame:
    """``corpus`` in the form that ``bm25`` reads for these queries, for callers that read its other columns too."""
    asked = written(query_terms(queries), "retrieval_asked")
    return counted(corpus, asked) if asked.count() <= MOST_TERMS else tokenised(corpus)


def _numbered(asked: DataFrame) -> dict[str, int]:
    """A number for each term of the queries."""
    return {term: i for i, term in enumerate(sorted(r["term"] for r in asked.select("term").distinct().collect()))}


def counted(corpus: DataFrame, asked: DataFrame) -> DataFrame:
    """``corpus`` with ``arms`` and, for its text, ``doc_length``, the numbers of the asked terms in it (``term``) and how often it has each (``tf``).

    Written once.  A row stays a row, so no posting is shuffled; ``MOST_TERMS`` bounds the terms that are sent to every task.
    """
    ship_package(corpus.sparkSession)
    arms = F.col("arms") if "arms" in corpus.columns else F.array("arm")
    text = F.array_join("words", " ") if "words" in corpus.columns else F.lower(F.coalesce("text", F.lit("")))
    others = [c for c in corpus.columns if c not in ("arm", "arms", "text", "words", "doc_length")]
    rows = corpus.select(*others, arms.alias("arms"), text.alias("text"))
    numbers = _numbered(asked)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find, number, known = re.compile("[a-z0-9]+").findall, numbers.__getitem__, numbers.keys()
        for batch in batches:
            for low in range(0, batch.num_rows, COUNT_BLOCK):
                part, lengths, ends, term, tf = batch.slice(low, COUNT_BLOCK), [], [0], [], []
                for text in part.column(part.num_columns - 1).to_pylist():
                    words = find(text)
                    times = Counter(words)
                    here = known & times.keys()
                    lengths.append(len(words))
                    term += map(number, here)
                    tf += map(times.__getitem__, here)
                    ends.append(len(term))
                lists = (pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (term, tf))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(lengths, pa.int32()), *lists], [*part.schema.names[:-1], "doc_length", "term", "tf"])

    schema = StructType([*rows.drop("text").schema.fields, *StructType.fromDDL("doc_length int, term array<int>, tf array<int>").fields])
    return written(rows.mapInArrow(count, schema), "retrieval_counts")


def bm25(corpus: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """The best ``k`` documents of each query and arm: arm, query_id, rank, doc and score (six decimals).

    ``corpus(arm, doc, text)``, or what ``prepared`` has made of it; a term that a query repeats counts that often; documents without a
    term of the query are not found; equal scores are ordered by doc; rows that share a doc are one document.  A document is
    scored for all queries where it is, and each task gives ``k`` documents for each query and arm at most.
    """
    asked = written(query_terms(queries), "retrieval_asked")
    if asked.count() > MOST_TERMS:
        corpus = corpus if "words" in corpus.columns else tokenised(corpus)
        found, statistics = written(postings(corpus, asked), "retrieval_postings"), written(corpus_statistics(corpus), "retrieval_statistics")
        df = found.groupBy("arm", "term").agg(F.count("*").alias("df"))
        scores = _joined_scores(found, _weights(df, statistics, asked), False)
    else:
        scores = _packed_scores(corpus if "tf" in corpus.columns else counted(corpus, asked), asked, k)
    return _best(scores, ["arm", "query_id"], "doc", k).select("arm", "query_id", "doc", "score", "rank")


def _weights(df: DataFrame, statistics: DataFrame, asked: DataFrame) -> DataFrame:
    """What a term adds to a query's score in each arm, with the arm's mean length, from the documents that have it."""
    weights = _idf(df, statistics).join(F.broadcast(statistics), "arm").join(asked, "term")
    return written(weights.select("arm", "term", "query_id", (F.col("times") * F.col("idf")).alias("weight"), "mean_length"), "retrieval_weights")


def _joined_scores(found: DataFrame, weights: DataFrame, small: bool) -> DataFrame:
    """Scores by a join of postings; a document's postings are dealt to one task, so that its scores are added up there."""
    norm = F.when(F.col("mean_length") > 0, 1 - B + B * F.col("doc_length") / F.col("mean_length")).otherwise(1.0)
    score = F.col("weight") * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * norm)
    rows = found.repartition("arm", "doc").join(F.broadcast(weights) if small else weights, ["arm", "term"])
    return rows.groupBy("arm", "doc", "query_id").agg(F.round(F.sum(score), 6).alias("score"))


def _packed_scores(counts: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Scores of a ``counted`` corpus: those that may be among the ``k`` best, and all of documents that several rows share.

    Shared documents, whose rows are counted and scored together, take the longer way of ``_joined_scores``.  They are told by a hash of
    doc alone; another document that has the same hash only goes that way too.
    """
    ship_package(counts.sparkSession)
    numbers = _numbered(asked)
    named = F.broadcast(counts.sparkSession.createDataFrame(list(numbers.items()), "term string, number int"))
    key, row = F.xxhash64("doc"), ["arms", "doc", "doc_length", "term", "tf"]
    several = written(counts.groupBy(key.alias("key")).agg(F.count("*").alias("n")).where("n > 1").select("key"), "retrieval_several")
    n = several.count()
    these = F.broadcast(several) if n <= MOST_TERMS else several
    keyed = counts.select(key.alias("key"), *row)
    single = (keyed.join(these, "key", "left_anti") if n else counts).select(*row)
    shared = keyed.join(these, "key", "left_semi").select(F.explode("arms").alias("arm"), "doc", "doc_length", F.arrays_zip("term", "tf").alias("posts"))
    shared = shared.select("arm", "doc", "doc_length", F.inline("posts").alias("number", "tf")).groupBy("arm", "doc", "doc_length", "number").agg(F.sum("tf").alias("tf"))
    shared = written(shared.join(named, "number").drop("number"), "retrieval_shared")

    alone = single.select("arms", F.explode("term").alias("number")).groupBy("arms", "number").agg(F.count("*").alias("n"))
    alone = alone.select(F.explode("arms").alias("arm"), "number", "n").join(named, "number").drop("number")
    df = alone.unionByName(shared.groupBy("arm", "term").agg(F.count("*").alias("n"))).groupBy("arm", "term").agg(F.sum("n").alias("df"))
    statistics = written(corpus_statistics(counts), "retrieval_statistics")
    weights = _weights(df, statistics, asked)
    got = weights.collect()

    ids = list({r["query_id"]: None for r in got})
    place = {q: i for i, q in enumerate(ids)}
    arms = {}
    for arm, mean in ((r["arm"], r["mean_length"]) for r in statistics.collect()):
        mine = sorted((numbers[r["term"]], place[r["query_id"]], r["weight"]) for r in got if r["arm"] == arm)
        term, query, weight = (np.array([r[i] for r in mine], dtype=kind) for i, kind in enumerate((np.int64, np.int64, float)))
        arms[arm] = mean, np.searchsorted(term, np.arange(len(numbers) + 1)), query, weight
    id_type = to_arrow_type(asked.schema["query_id"].dataType)
    schema = StructType([StructField("arm", StringType()), counts.schema["doc"], asked.schema["query_id"], StructField("score", DoubleType())])

    def scored(part: pa.RecordBatch, cut: dict) -> Iterator[pa.RecordBatch]:
        """Scores of a few rows.  ``cut``: the ``k`` best of each arm and query so far."""
        at, doc, length, term, tf = part.columns
        first, last = term.offsets.to_numpy()[[0, -1]]
        owner = np.repeat(np.arange(part.num_rows), np.diff(term.offsets.to_numpy()))
        used, number = np.unique(term.values.to_numpy()[first:last], return_inverse=True)
        if part.num_rows > 1 and part.num_rows * len(used) > CELLS:
            half = part.num_rows // 2
            yield from scored(part.slice(0, half), cut)
            yield from scored(part.slice(half), cut)
            return
        tf, length = tf.values.to_numpy()[slice(*tf.offsets.to_numpy()[[0, -1]])], length.to_numpy()
        in_arm, arm_of = at.flatten(), pc.list_parent_indices(at).to_numpy()
        for arm, (mean, starts, query, weight) in arms.items():
            rows = np.unique(arm_of[pc.equal(in_arm, arm).to_numpy(zero_copy_only=False)])
            if not len(rows) or not len(used):
                continue
            norm = 1 - B + B * length / mean if mean > 0 else np.ones(part.num_rows)
            x = np.zeros((part.num_rows, len(used)))
            x[owner, number] = tf * (K1 + 1) / (tf + K1 * norm[owner])
            x = x[rows] if len(rows) < part.num_rows else x
            size = starts[used + 1] - starts[used]
            take = np.repeat(starts[used] - np.cumsum(size) + size, size) + np.arange(size.sum())
            place, asking, by = np.repeat(np.arange(len(used)), size), query[take], weight[take]
            step = max(1, CELLS // max(len(used), len(rows)))
            for low in range(0, len(ids), step):
                n = min(step, len(ids) - low)
                w, mine = np.zeros((n, len(used))), (asking >= low) & (asking < low + n)
                w[asking[mine] - low, place[mine]] = by[mine]
                score = w @ x.T
                found = score > 0
                score = np.floor(score * 1e6 + 0.5) / 1e6
                best = np.concatenate([cut[arm][low : low + n], score], axis=1)
                best = cut[arm][low : low + n] = np.partition(best, -k, axis=1)[:, -k:]
                q, d = np.nonzero(found & (score >= best.min(axis=1, keepdims=True)))
                value, docs = score[q, d], doc.take(pa.array(rows[d]))
                if len(q) and np.bincount(q).max() > k:  # equal scores: those of the first documents
                    names, kept, ends = docs.to_pylist(), [], np.searchsorted(q, np.arange(n + 1))
                    for a, z in zip(ends[:-1], ends[1:], strict=True):
                        kept += sorted(range(a, z), key=lambda i: (-value[i], names[i] is not None, names[i]))[:k] if z - a > k else range(a, z)
                    q, value, docs = q[kept], value[kept], docs.take(pa.array(kept))
                if len(q):
                    yield pa.RecordBatch.from_arrays([pa.array([arm] * len(q), pa.string()), docs, pa.array([ids[i + low] for i in q], id_type), pa.array(value)], schema.names)

    def best_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = {arm: np.zeros((len(ids), k)) for arm in arms}
        for batch in batches:
            for low in range(0, batch.num_rows, ROW_BLOCK):
                yield from scored(batch.slice(low, ROW_BLOCK), cut)

    return single.mapInArrow(best_of, schema).unionByName(_joined_scores(shared, weights, True))


def _best(scores: DataFrame, by: list[str], tie: str, k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), tie)
    return scores.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def dense_search(vectors: DataFrame, queries: DataFrame, k: int = 5, where: Column | None = None, digits: int = 6, width: int | None = None) -> DataFrame:
    """The ``k`` vectors most like each query by cosine: query_id, rank, vec_id and score (rounded first).

    ``vectors(vec_id, embedding)`` pass the filter first.  ``queries(query_id, embedding)`` are sent to every task, in blocks of
    ``QUERY_BLOCK`` if they are more, and each task keeps ``k`` vectors for each query.  ``width`` is the vectors' length (the
    most frequent one among the queries unless given; of equally frequent ones the smaller): vectors and queries of another,
    null ones and those of zeros are not found.
    """
    ship_package(vectors.sparkSession)
    asked = queries.where("embedding is not null").select("query_id", F.col("embedding").cast("array<double>").alias("embedding"))
    if width is None:
        most = asked.groupBy(F.size("embedding").alias("width")).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "width").first()
        width = most["width"] if most else 0
    asked = asked.where((F.size("embedding") == width) & F.exists("embedding", lambda x: x != 0))
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    rows = (vectors if where is None else vectors.where(where)).select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where((F.size("embedding") == width) & ~F.exists("embedding", lambda x: x.isNull()))
    found = []
    for block in range(blocks):
        mine = asked if blocks == 1 else asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        found.append(_searched(rows, mine.collect(), width, k, digits))
    return _best(reduce(DataFrame.unionByName, found), ["query_id"], "vec_id", k)


def _searched(rows: DataFrame, asked: list, width: int, k: int, digits: int) -> DataFrame:
    """The best of every task for one block of queries."""
    matrix = np.array([r["embedding"] for r in asked], dtype=float).reshape(len(asked), width)
    ids = np.array([r["query_id"] for r in asked], dtype=np.int64)
    matrix = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), np.finfo(float).tiny)

    def best_of(at: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        scores = np.round(matrix @ x.T, digits)
        best = [np.lexsort((at, -row))[:k] for row in scores]
        which = np.repeat(np.arange(len(ids)), [len(b) for b in best])
        take = np.concatenate(best)
        return which, at[take], scores[which, take]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, ROW_BLOCK):
                part = batch.slice(low, ROW_BLOCK)
                x = part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
                length = np.linalg.norm(x, axis=1)
                at, x = part.column(0).to_numpy()[length > 0], x[length > 0] / length[length > 0, None]
                if len(ids) and len(at):
                    which, vec, score = best_of(at, x)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[which]), pa.array(vec), pa.array(score)], ["query_id", "vec_id", "score"])

    return rows.mapInArrow(search, "query_id long, vec_id long, score double")


def graded(results: DataFrame, targets: DataFrame) -> DataFrame:
    """results(arm, query_id, rank, source_id, section_key) with ``relevant`` and ``first`` (of its target in the list).

    ``targets(query_id, source_id, section_key)``; null section keys are equal to each other.
    """
    t = targets.select("query_id", "source_id", "section_key").distinct().withColumn("relevant", F.lit(True)).alias("t")
    r = results.alias("r")
    same = (F.col("r.query_id") == F.col("t.query_id")) & F.col("r.source_id").eqNullSafe(F.col("t.source_id")) & F.col("r.section_key").eqNullSafe(F.col("t.section_key"))
    rows = r.join(F.broadcast(t) if t.count() <= MOST_TARGETS else t, same, "left").select("r.*", F.coalesce("t.relevant", F.lit(False)).alias("relevant"))
    place = Window.partitionBy("arm", "query_id", "source_id", "section_key").orderBy("rank")
    return rows.withColumn("first", F.col("relevant") & (F.row_number().over(place) == 1))


def metrics(results: DataFrame, targets: DataFrame, queries: DataFrame, arms: tuple[str, ...] = ("whole", "split"), k: int = 5) -> DataFrame:
    """hit, recall, mrr and ndcg at ``k`` for every arm and query, found or not."""
    marked = graded(results.where(F.col("rank") <= k), targets)
    gain = F.when(F.col("first"), 1 / F.log2(F.col("rank") + F.lit(1.0))).otherwise(0.0)
    got = marked.groupBy("arm", "query_id").agg(
        F.max(F.col("relevant").cast("int")).alias("hit"), F.sum(F.col("first").cast("int")).alias("found"), F.min(F.when(F.col("relevant"), F.col("rank"))).alias("at"), F.sum(gain).alias("dcg")
    )
    wanted = targets.select("query_id", "source_id", "section_key").distinct().groupBy("query_id").agg(F.count("*").alias("wanted"))
    ideal = F.aggregate(F.sequence(F.lit(1), F.least(F.col("wanted"), F.lit(k)).cast("int")), F.lit(0.0), lambda s, i: s + 1 / F.log2(i + F.lit(1.0)))
    every = queries.withColumn("arm", F.explode(F.array(*map(F.lit, arms)))).join(wanted, "query_id", "left").join(got, ["arm", "query_id"], "left")
    zero = F.lit(0.0)
    return every.select(
        "arm", "query_id", *(c for c in queries.columns if c == "class"),
        F.coalesce(F.col("hit").cast("double"), zero).alias("hit"),
        F.coalesce(F.col("found") / F.col("wanted"), zero).alias("recall"),
        F.coalesce(1 / F.col("at"), zero).alias("mrr"),
        F.when(F.col("wanted") > 0, F.coalesce(F.col("dcg") / ideal, zero)).otherwise(zero).alias("ndcg"),
    )


def comparison(scores: DataFrame, arms: tuple[str, str] = ("whole", "split"), least: float = 1e-9) -> DataFrame:
    """class (``all`` for all), metric, n, the mean of each arm, delta and trend (+, -, =)."""
    means = scores.groupingSets([["class", "arm"], ["arm"]], "class", "arm").agg(F.count("*").alias("n"), *(F.avg(m).alias(m) for m in METRICS), F.grouping("class").alias("_g"))
    means = means.withColumn("class", F.when(F.col("_g") == 1, "all").otherwise(F.col("class")))
    long = means.unpivot(["class", "arm", "n"], list(METRICS), "metric", "value")
    a, b = arms
    wide = long.groupBy("class", "metric").pivot("arm", list(arms)).agg(F.first("value").alias("v"), F.first("n").alias("n"))
    delta = F.col(f"{b}_v") - F.col(f"{a}_v")
    return wide.select(
        "class", "metric", F.coalesce(f"{a}_n", f"{b}_n").alias("n"), F.round(f"{a}_v", 6).alias(a), F.round(f"{b}_v", 6).alias(b), F.round(delta, 6).alias("delta"),
        F.when(F.abs(delta) < least, "=").when(delta > 0, "+").otherwise("-").alias("trend"),
    )


def crowding(scores: DataFrame, arms: tuple[str, str] = ("whole", "split"), control: str = "control") -> DataFrame:
    """Questions of class ``control`` whose metrics differ between the arms, and their number at all."""
    rows = scores.where(F.col("class") == control).groupBy("query_id").pivot("arm", list(arms)).agg(F.first(F.struct(*METRICS)))
    return rows.agg(F.count_if(~F.col(arms[0]).eqNullSafe(F.col(arms[1]))).alias("moved"), F.count("*").alias("n_control"))


def structural_problems(chunks: DataFrame, arm_a: DataFrame, arm_b: DataFrame) -> DataFrame:
    """problem and n: standard chunks that an arm lacks, chunks that differ between the arms, and tags in the wrong arm."""
    standard = chunks.where("chunk_strategy = 'standard'").select("chunk_id")
    both = arm_a.select("chunk_id", F.col("chunk_text").alias("a")).join(arm_b.select("chunk_id", F.col("chunk_text").alias("b")), "chunk_id")
    checks = {
        "standard chunk absent from arm A": standard.join(arm_a.select("chunk_id"), "chunk_id", "left_anti"),
        "standard chunk absent from arm B": standard.join(arm_b.select("chunk_id"), "chunk_id", "left_anti"),
        "chunk with different text": both.where(~F.col("a").eqNullSafe(F.col("b"))),
        "sub_split chunk in arm A": arm_a.where("chunk_strategy = 'sub_split'"),
        "oversized_whole chunk in arm B": arm_b.where("chunk_strategy = 'oversized_whole'"),
    }
    out = None
    for name, rows in checks.items():
        row = rows.agg(F.count("*").alias("n")).select(F.lit(name).alias("problem"), "n")
        out = row if out is None else out.unionByName(row)
    return out
