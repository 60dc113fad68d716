"""Keyword, vector and combined search of many questions at once."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from millrace.functions import scoring, vectors
from millrace.functions.text import term_counts, tokens
from millrace.functions.vectors import DIMENSIONS
from millrace.operators.documents import CITATION_COLUMNS
from millrace.operators.postings import CODEC, PUSHED, KeywordIndex, idf, index_terms, rank_hits, saturation
from millrace.session import new_path, release, written, written_to
from millrace.sizing import lookup_join

# The scoring code travels with each task, so that executors need no copy of this package.
cloudpickle.register_pickle_by_value(scoring)
cloudpickle.register_pickle_by_value(vectors)

# The constant of reciprocal rank fusion (Cormack, Clarke and Buettcher, 2009).
FUSION = 60
POOL = 50

# Questions are scored in blocks, so that the table each task holds has a known size.
BLOCK_QUERIES = 512
BLOCK_ENTRIES = 400_000
BLOCK_CELLS = 4_000_000
PUSHED_BUCKETS = 10_000
# So many terms count as frequent at most, so no other term has more than one of so many postings. Longer ones count as rare.
FREQUENT = 65_536
FREQUENT_CHARS = 64
# Signs of a sketch for each component of a vector, and how many vectors per hit are compared exactly.
SIGNS = 8
COMPARED = 20


# --- index -------------------------------------------------------------------------------------------------------


ENTRY = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("value", T.DoubleType())])


@dataclass(frozen=True)
class TermWeights:
    """How many chunks there are, and ``term, frequency``: in how many of them each term is."""

    documents: int
    frequencies: DataFrame

    @cached_property
    def frequent(self) -> dict[str, float]:
        """The weights of the most frequent terms: at most ``FREQUENT`` terms of ``FREQUENT_CHARS`` come to the driver, whatever the vocabulary.

        Of terms with the same frequency all are taken or none.
        """
        short = self.frequencies.filter(F.length("term") <= FREQUENT_CHARS)
        many = short.groupBy("frequency").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("frequency")).limit(FREQUENT)
        least, taken = None, 0
        for frequency, n in map(tuple, many.collect()):
            taken += n
            if taken > FREQUENT:
                break
            least = frequency
        if least is None:
            return {}
        found = short.filter(F.col("frequency") >= least).select("term", idf(F.lit(self.documents), F.col("frequency"))).collect()
        return dict(map(tuple, found))

    def table(self, dims: int) -> tuple[list[str], np.ndarray, np.ndarray]:
        """The frequent terms in order, which are their codes, with the dimension of each and its weight with the sign."""
        names = sorted(self.frequent)
        dim, sign = vectors.places(names, dims)
        return names, dim, sign * np.array([self.frequent[term] for term in names], np.float64)


def term_weights(index: DataFrame) -> TermWeights:
    """The weights of the terms of :func:`index_terms`, counted by partial sums."""
    counted = index.select(F.explode("terms.term").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))
    return TermWeights(index.count(), written(counted, "frequencies"))


def add_vectors(rows: DataFrame, weights: TermWeights, dims: int = DIMENSIONS) -> DataFrame:
    """``rows`` with the unit ``vector`` (dim, value) of their ``terms`` in place of these.

    A term adds its count times its inverse document frequency, with a sign, to one of ``dims`` places. Weights of frequent terms are
    sent to the rows; those of all others are joined by term, and no such term has much of the data. A term without
    frequency weighs as one that is in no chunk.
    """
    names, *table = weights.table(dims)
    return unit_vectors(coded_terms(rows, weights, names, dims, new_path(rows.sparkSession, "coded")), table, dims)


def unit_vectors(coded: DataFrame, table: list[np.ndarray], dims: int = DIMENSIONS) -> DataFrame:
    """:func:`coded_terms` with the unit ``vector`` in place of their last three columns."""
    known = coded.sparkSession.sparkContext.broadcast(table)
    schema = T.StructType([*coded.schema.fields[:-3], T.StructField("vector", T.ArrayType(ENTRY))])
    return coded.mapInArrow(vectors.finisher(known, dims), schema)


def coded_terms(rows: DataFrame, weights: TermWeights, names: list[str], dims: int, path: str) -> DataFrame:
    """``rows`` with three columns in place of ``terms``: the codes of frequent terms, which are their places in ``names``, the
    counts of these, and the (dim, value) of all others, whose weights are joined by term. ``path`` and the same with ``-rest`` are working folders, which the result reads.

    This is a third of the bytes of the vectors, each of which has its own values.
    """
    count = T.StructType([T.StructField("term", T.StringType()), T.StructField("tf", T.IntegerType())])
    others = [f for f in rows.schema.fields if f.name != "terms"]
    numbered = rows.select(F.monotonically_increasing_id().alias("_row"), *[f.name for f in others], "terms")
    near = [T.StructField("_codes", T.ArrayType(T.ShortType())), T.StructField("_counts", T.ArrayType(T.IntegerType()))]
    schema = T.StructType([T.StructField("_row", T.LongType()), *others, *near, T.StructField("_far", T.ArrayType(count))])
    known = rows.sparkSession.sparkContext.broadcast({term: code for code, term in enumerate(names)})
    parts = written_to(path, numbered.mapInArrow(vectors.coder(known), schema), CODEC)
    far = parts.select("_row", F.inline("_far"))
    # The same words of the digest as in the batches.
    word = lambda start, digits: F.conv(F.substring(F.md5("term"), start, digits), 16, 10).cast("long")
    sign = F.when(word(9, 1) % 2 == 0, 1.0).otherwise(-1.0)
    weight = idf(F.lit(weights.documents), F.coalesce("frequency", F.lit(0)))
    # Spark would broadcast all frequencies where their files are small.
    joined = far.join(weights.frequencies.hint("merge"), "term", "left").select(
        "_row", F.struct((word(1, 8) % dims).cast("int").alias("dim"), (sign * F.col("tf") * weight).alias("value")).alias("e")
    )
    # Written, so that the files of these two shuffles can go before the next one.
    rest = written_to(f"{path}-rest", joined.groupBy("_row").agg(F.collect_list("e").alias("_rest")), CODEC)
    del far, joined
    release(rows.sparkSession)
    both = parts.drop("_far").join(rest.hint("merge"), "_row", "left")
    return both.select(*[f.name for f in others], "_codes", "_counts", F.coalesce("_rest", F.array().cast(T.ArrayType(ENTRY))).alias("_rest"))


class Index:
    """A search index that is kept in a folder: the keyword index, and the vectors of its chunks as of the last sync.

    A sync brings the keyword index up to date by what changed. Vectors are written anew when something has, as each depends on the
    frequencies in all chunks. They lie as codes of terms, beside the weights of these; who reads them gets the unit vectors.
    """

    def __init__(self, spark: SparkSession, path: str, dims: int = DIMENSIONS):
        self.spark, self.path, self.dims = spark, path.rstrip("/"), dims
        self.keyword = KeywordIndex(spark, f"{self.path}/keyword")

    def sync(self, chunks: DataFrame) -> bool:
        """Bring the index to the state of ``chunks``. False if nothing changed."""
        changed = self.keyword.sync(chunks)
        self._write_vectors()
        return changed

    def remove(self, paths: DataFrame) -> None:
        """Take out the chunks of documents."""
        self.keyword.remove(paths)
        self._write_vectors()

    @property
    def terms(self) -> DataFrame:
        return self.keyword.live()

    @property
    def weights(self) -> TermWeights:
        return TermWeights(self.keyword.totals()[0], self.keyword.frequencies())

    @property
    def vectors(self) -> DataFrame:
        self._write_vectors()  # in an index of an earlier form
        table = self.spark.read.schema("code int, dim int, weight double").parquet(self._state("weights")).toArrow().sort_by("code")
        known = [table.column(name).to_numpy() for name in ("dim", "weight")]
        return unit_vectors(self.spark.read.parquet(self._state("coded")), known, self.dims)

    def _state(self, name: str) -> str:
        return f"{self.path}/{name}/state={self.keyword.segments()[-1]}"

    def _write_vectors(self) -> None:
        jvm = self.spark.sparkContext._jvm
        done = jvm.org.apache.hadoop.fs.Path(f"{self._state('coded')}/_SUCCESS")
        if done.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            return
        weights, path = self.weights, new_path(self.spark, "coded")
        names, dim, weight = weights.table(self.dims)
        table = pa.table({"code": pa.array(range(len(names)), pa.int32()), "dim": pa.array(dim, pa.int32()), "weight": pa.array(weight, pa.float64())})
        self.spark.createDataFrame(table).coalesce(1).write.mode("overwrite").parquet(self._state("weights"))
        coded = coded_terms(self.terms.select("chunk_id", "terms"), weights, names, self.dims, path)
        coded.write.mode("overwrite").option("compression", CODEC).parquet(self._state("coded"))
        del coded
        release(self.spark, path, f"{path}-rest")


def build_index(chunks: DataFrame, dims: int = DIMENSIONS) -> Index:
    """An index in a folder of its own."""
    index = Index(chunks.sparkSession, new_path(chunks.sparkSession, "index"), dims)
    index.sync(chunks)
    return index


def question_terms(questions: DataFrame, id_col: str, text: str) -> DataFrame:
    return questions.select(F.col(id_col).alias("query_id"), term_counts(tokens(F.col(text))).alias("terms"))


# --- scoring -----------------------------------------------------------------------------------------------------


def _bounded(rows: DataFrame, limit: int) -> list[pa.Table]:
    """The rows of the questions, in tables of about ``limit`` rows; a question is never split.

    Usually that is one table. More questions than that are parted by a hash of their id and taken one part at a time.
    """
    head = rows.limit(limit + 1).toArrow()
    if head.num_rows <= limit:
        return [head]
    rows = written(rows, "asked")
    parts = -(-rows.count() // limit)
    block = F.pmod(F.xxhash64("query_id"), F.lit(parts))
    return [rows.filter(block == n).toArrow() for n in range(parts)]


def _hit_schema(rows: DataFrame, id_col: str, queries: DataFrame) -> T.StructType:
    return T.StructType(
        [
            T.StructField("query_id", queries.schema["query_id"].dataType),
            T.StructField(id_col, rows.schema[id_col].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )


def _arrow(schema: T.StructType) -> pa.Schema:
    return pa.schema([pa.field(f.name, to_arrow_type(f.dataType)) for f in schema])


def sparse_top_k(rows: DataFrame, id_col: str, entries: Column, asked: DataFrame, k: int) -> DataFrame:
    """The ``k`` rows with the largest positive dot product for each question, rounded to six places.

    ``entries`` is an ``array<struct<key, weight>>`` of each row, and ``asked`` has ``query_id, key, weight``. Every row is
    read where it lies and compared with all questions of a block; a task returns at most ``k`` rows per question. Nothing
    of the size rows times questions is ever shuffled or kept.
    """
    slim = rows.select(id_col, entries.alias("entries"))
    schema = _hit_schema(rows, id_col, asked)
    hits = []
    for table in _bounded(asked.select("query_id", "key", "weight"), BLOCK_ENTRIES):
        for part in _fit(table):
            keys = part.column("key").combine_chunks().unique()
            query_ids = part.column("query_id").combine_chunks().unique()
            weights = np.zeros((len(keys), len(query_ids)))
            at = (
                pc.index_in(part.column("key"), value_set=keys).to_numpy(),
                pc.index_in(part.column("query_id"), value_set=query_ids).to_numpy(),
            )
            np.add.at(weights, at, part.column("weight").to_numpy())
            run = scoring.sparse_scorer(keys, weights, query_ids, k, _arrow(schema))
            hits.append(slim.mapInArrow(run, schema))
    # Without any key in common there is nothing to find.
    hits = hits or [rows.sparkSession.createDataFrame([], schema)]
    return rank_hits(reduce(DataFrame.unionAll, hits), k, id_col)


def _fit(table: pa.Table) -> list[pa.Table]:
    """Split a block whose questions share so few keys that its table of keys times questions would be too big."""
    query_ids = table.column("query_id").combine_chunks().unique()
    keys = table.column("key").combine_chunks().unique()
    if not table.num_rows:
        return []
    if len(query_ids) == 1 or len(query_ids) <= BLOCK_QUERIES and len(keys) * len(query_ids) <= BLOCK_CELLS:
        return [table]
    first = pc.is_in(table.column("query_id"), value_set=query_ids[: len(query_ids) // 2])
    return [*_fit(table.filter(first)), *_fit(table.filter(pc.invert(first)))]


def bm25_top_k(index: DataFrame, questions: DataFrame, k: int, id_col: str = "chunk_id") -> DataFrame:
    """Keyword search over :func:`index_terms` without a kept index, by one scan: ``query_id, id, score, rank``.

    ``questions`` has ``query_id`` and ``terms``. For chunks that are searched once; else see ``KeywordIndex``.
    """
    stats = index.agg(F.count(F.lit(1)).alias("n"), F.avg("n_terms").alias("mean"))
    asked = questions.select(F.explode("terms").alias("t")).select("t.term").distinct()
    # Only terms that somebody asks for are counted, so no table of the whole vocabulary is built.
    frequency = (
        lookup_join(index.select(id_col, F.explode("terms.term").alias("term")), asked, ["term"], "left_semi")
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    weighted = (
        questions.select("query_id", F.explode("terms.term").alias("term"))
        .join(frequency, "term")
        .select(
            "query_id", F.col("term").alias("key"), idf(stats.select("n").scalar(), F.col("frequency")).alias("weight")
        )
    )
    measured = index.select(id_col, "terms", "n_terms", stats.select("mean").scalar().alias("_mean"))
    entries = F.transform(
        "terms",
        lambda t: F.struct(
            t["term"].alias("key"),
            saturation(t["tf"], F.col("n_terms"), F.col("_mean")).alias("weight"),
        ),
    )
    return sparse_top_k(measured, id_col, entries, weighted, k)


def question_vectors(questions: DataFrame, weights: TermWeights, dims: int = DIMENSIONS) -> DataFrame:
    """The hashed vectors of questions as ``query_id, key, weight``, a row per dimension."""
    return add_vectors(questions, weights, dims).select("query_id", F.inline("vector")).toDF("query_id", "key", "weight")


def vector_top_k(vectors_: DataFrame, asked: DataFrame, k: int, id_col: str = "chunk_id") -> DataFrame:
    """Exact cosine search over the hashed vectors: ``query_id, id, score, rank``."""
    return sparse_top_k(vectors_, id_col, F.col("vector"), asked, k)


def fuse(ranked: list[DataFrame], k: int, id_col: str = "chunk_id") -> DataFrame:
    """Reciprocal rank fusion of ranked lists."""
    votes = [hits.select("query_id", id_col, (1.0 / (FUSION + F.col("rank"))).alias("vote")) for hits in ranked]
    scores = reduce(DataFrame.unionAll, votes).groupBy("query_id", id_col).agg(F.round(F.sum("vote"), 8).alias("score"))
    return rank_hits(scores, k, id_col)


def search_all(index: Index, questions: DataFrame, k: int, pool: int = POOL) -> dict[str, DataFrame]:
    """The ``KEYWORD``, ``ANN`` and ``HYBRID`` answers. The ranked pools are written once and shared."""
    asked = question_vectors(questions, index.weights, index.dims)
    keyword = written(index.keyword.top_k(questions, max(k, pool)), "keyword")
    semantic = written(vector_top_k(index.vectors, asked, max(k, pool)), "semantic")
    top = lambda hits, n: hits.filter(F.col("rank") <= n)
    return {
        "KEYWORD": top(keyword, k),
        "ANN": top(semantic, k),
        "HYBRID": fuse([top(keyword, pool), top(semantic, pool)], k),
    }


def with_citations(hits: DataFrame, chunks: DataFrame) -> DataFrame:
    """Add the text and the citation of each hit. Only the cited columns of the chunks are read."""
    return lookup_join(chunks.select(*CITATION_COLUMNS), hits, ["chunk_id"]).select(
        "query_id", "rank", "score", *CITATION_COLUMNS
    )


def rerank(candidates: DataFrame, vectors_: DataFrame, asked: DataFrame, k: int, id_col: str = "chunk_id") -> DataFrame:
    """Second stage: order the candidates of each question by exact cosine."""
    pairs = lookup_join(vectors_.select(id_col, "vector"), candidates.select("query_id", id_col), [id_col])
    left = pairs.select("query_id", id_col, F.inline("vector")).toDF("query_id", id_col, "key", "value")
    scores = (
        left.join(asked, ["query_id", "key"], "left")
        .groupBy("query_id", id_col)
        .agg(F.round(F.coalesce(F.sum(F.col("value") * F.col("weight")), F.lit(0.0)), scoring.ROUND).alias("score"))
    )
    return rank_hits(scores, k, id_col)


# --- dense vectors -----------------------------------------------------------------------------------------------


def dense_top_k(rows: DataFrame, id_col: str, queries: DataFrame, k: int, vector: str = "embedding") -> DataFrame:
    """Exact cosine search over dense vectors, with questions ``query_id, embedding``."""
    slim = rows.select(id_col, vector)
    schema = _hit_schema(rows, id_col, queries)
    hits = []
    for table in _bounded(queries.select("query_id", "embedding"), BLOCK_QUERIES):
        if table.num_rows:
            asked = scoring.unit_rows(scoring.matrix(table.column("embedding").combine_chunks()))
            query_ids = table.column("query_id").combine_chunks()
            hits.append(slim.mapInArrow(scoring.dense_scorer(asked, query_ids, k, _arrow(schema)), schema))
    hits = hits or [rows.sparkSession.createDataFrame([], schema)]
    return rank_hits(reduce(DataFrame.unionAll, hits), k, id_col)


def planes(tables: int, bits: int, dims: int) -> np.ndarray:
    """Random hyperplanes with entries +1 and -1, from the parity of a digest of their place."""
    if min(tables, bits, dims) < 1 or bits > 30:
        raise ValueError("tables, bits and dims must be positive, and bits at most 30")
    parity = lambda t, b, d: int(md5(f"{t}:{b}:{d}".encode()).hexdigest()[:2], 16) % 2
    return np.array(
        [[[1.0 if parity(t, b, d) == 0 else -1.0 for d in range(dims)] for b in range(bits)] for t in range(tables)]
    )


def bucketed(rows: DataFrame, tables: int, bits: int, dims: int, vector: str = "embedding") -> DataFrame:
    """One row per vector and hash table, with its ``bucket``; the buckets of all tables are numbered through."""
    others = [c for c in rows.columns if c != vector]
    slim = rows.select(*others, vector)
    schema = T.StructType([*slim.schema.fields, T.StructField("codes", T.ArrayType(T.IntegerType()))])
    coded = slim.mapInArrow(scoring.bucket_codes(planes(tables, bits, dims)), schema)
    return coded.select(F.posexplode("codes").alias("table_no", "code"), *others, vector).select(
        (F.col("table_no").cast("long") * (1 << bits) + F.col("code")).alias("bucket"), *others, vector
    )


def write_buckets(rows: DataFrame, id_col: str, path: str, tables: int, bits: int, dims: int) -> None:
    """Write :func:`bucketed` vectors in order of their bucket, so that a search can skip what it does not ask for.

    Ranges of bucket and id are written, not one file per bucket: a bucket with much of the data becomes many files.
    """
    ordered = bucketed(rows.select(id_col, "embedding"), tables, bits, dims).repartitionByRange("bucket", id_col)
    ordered.sortWithinPartitions("bucket", id_col).write.parquet(path)


def lsh_top_k(
    buckets: DataFrame, id_col: str, queries: DataFrame, k: int, tables: int, bits: int, dims: int
) -> DataFrame:
    """Approximate search: only vectors that share a bucket with the question are scored, and those exactly.

    ``buckets`` comes from :func:`write_buckets`; the buckets asked for reach the scan as a filter. A vector may share
    several buckets with a question, so ``k * tables`` hits are kept until duplicates are gone and none of the best ``k``
    is lost.
    """
    asked = bucketed(queries.select("query_id", "embedding"), tables, bits, dims)
    asked = written(asked.withColumnRenamed("embedding", "asked"), "asked")
    numbers = [row[0] for row in asked.select("bucket").distinct().limit(PUSHED_BUCKETS + 1).collect()]
    if len(numbers) <= PUSHED_BUCKETS:
        buckets = buckets.filter(F.col("bucket").isin(numbers))
    found = lookup_join(buckets, asked, ["bucket"], spread_by=F.col(id_col))
    cosine = _cosine(F.col("embedding"), F.col("asked"))
    scored = found.select("query_id", id_col, F.round(cosine, scoring.ROUND).alias("score"))
    pool = rank_hits(scored, k * tables, id_col).drop("rank")
    return rank_hits(pool.dropDuplicates(["query_id", id_col]), k, id_col)


def sketch_planes(bits: int, dims: int) -> np.ndarray:
    """Random hyperplanes, a row each, with entries +1 and -1 from the parity of a digest of their place."""
    if min(bits, dims) < 1 or bits % 64:
        raise ValueError("dims must be positive and bits a multiple of 64")
    parity = lambda b, d: int(md5(f"sketch:{b}:{d}".encode()).hexdigest()[:2], 16) % 2
    return np.array([[1.0 if parity(b, d) == 0 else -1.0 for d in range(dims)] for b in range(bits)])


class SketchIndex:
    """Approximate search that compares few vectors: sketches of signs are scanned, and the nearest by them compared exactly.

    ``sketches`` has a quarter of the bytes of single-precision vectors. ``vectors`` are kept in order of their id, so that only those asked for are read.
    A question's ``COMPARED`` times ``k`` nearest sketches, by differing signs and then id, are its candidates.
    """

    def __init__(self, spark: SparkSession, path: str, id_col: str, dims: int):
        self.spark, self.path, self.id_col, self.dims = spark, path.rstrip("/"), id_col, dims
        self.planes = sketch_planes(SIGNS * dims, dims)

    def _sketched(self, rows: DataFrame, id_col: str) -> DataFrame:
        schema = T.StructType([rows.schema[id_col], T.StructField("sketch", T.BinaryType())])
        return rows.select(id_col, "embedding").mapInArrow(scoring.sketcher(self.planes), schema)

    def write(self, rows: DataFrame) -> SketchIndex:
        vectors_ = rows.select(self.id_col, "embedding").repartitionByRange(self.id_col).sortWithinPartitions(self.id_col)
        vectors_.write.parquet(f"{self.path}/vectors")
        self._sketched(self._vectors(), self.id_col).write.parquet(f"{self.path}/sketches")
        return self

    def _vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    def candidates(self, queries: DataFrame, n: int) -> DataFrame:
        """``query_id, id``: the ``n`` vectors whose sketches differ least from the question's."""
        sketches = self.spark.read.parquet(f"{self.path}/sketches")
        schema = _hit_schema(sketches, self.id_col, queries)
        hits = []
        for table in _bounded(self._sketched(queries, "query_id"), BLOCK_QUERIES):
            if table.num_rows:
                asked = scoring.sketch_matrix(table.column("sketch").combine_chunks())
                run = scoring.sketch_scorer(asked, table.column("query_id").combine_chunks(), n, _arrow(schema))
                hits.append(sketches.mapInArrow(run, schema))
        hits = hits or [self.spark.createDataFrame([], schema)]
        return rank_hits(reduce(DataFrame.unionAll, hits), n, self.id_col).select("query_id", self.id_col)

    def top_k(self, queries: DataFrame, k: int) -> DataFrame:
        """``query_id, id, score, rank`` of questions ``query_id, embedding`` by cosine among the candidates."""
        chosen = written(self.candidates(queries, COMPARED * k), "candidates")
        ids = [r[0] for r in chosen.select(self.id_col).distinct().limit(PUSHED + 1).collect()]
        vectors_ = self._vectors()
        if len(ids) <= PUSHED:
            vectors_ = vectors_.filter(F.col(self.id_col).isin(ids))  # of any type
        pairs = lookup_join(vectors_, chosen, [self.id_col], spread_by=F.col(self.id_col))
        asked = queries.select("query_id", F.col("embedding").alias("_asked"))
        scored = lookup_join(pairs, asked, ["query_id"], spread_by=F.col(self.id_col)).select(
            "query_id", self.id_col, F.round(_cosine(F.col("embedding"), F.col("_asked")), scoring.ROUND).alias("score")
        )
        return rank_hits(scored, k, self.id_col)


def _cosine(a: Column, b: Column) -> Column:
    number = lambda v: F.transform(v, lambda x: x.cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda total, p: total + p)
    u, v = number(a), number(b)
    return F.try_divide(dot(u, v), F.sqrt(dot(u, u)) * F.sqrt(dot(v, v)))


def recall(found: DataFrame, exact: DataFrame, id_col: str) -> DataFrame:
    """``wanted, found, recall``: how many of the ``exact`` hits are among those ``found``."""
    pairs = exact.select("query_id", id_col).join(found.select("query_id", id_col, F.lit(1).alias("_hit")), ["query_id", id_col], "left")
    counted = pairs.agg(F.count(F.lit(1)).alias("wanted"), F.count("_hit").alias("found"))
    return counted.withColumn("recall", F.round(F.try_divide("found", "wanted"), 6))


def centroids(rows: DataFrame, group: str, vector: str = "embedding") -> DataFrame:
    """The mean vector of each group as a question."""
    return (
        rows.select(F.col(group).alias("query_id"), F.posexplode(vector).alias("i", "x"))
        .groupBy("query_id", "i")
        .agg(F.avg("x").alias("x"))
        .groupBy("query_id")
        .agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("xs"))
        .select("query_id", F.transform("xs", lambda e: e["x"]).alias("embedding"))
    )
