"""A keyword index that is kept: postings by term in blocks with bounds of their scores, brought up to date by what changed."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import scoring
from millrace.functions.text import term_counts, tokens
from millrace.session import new_path, release, written, written_to
from millrace.sizing import is_small, lookup_join

cloudpickle.register_pickle_by_value(scoring)

# The usual BM25 constants.
K1 = 1.2
B = 0.75

BLOCK = 256
# So many names go to the scan as a filter; more are joined.
PUSHED = 2_000
# A question's rarest terms are read first, until they have about so many postings for each hit that is asked for.
FIRST_READ = 400
# Scores are rounded to six places; a bound that is this much short of the bar cannot be rounded up to it.
SLACK = 1e-5
# Terms are left out whose bounds together stay under this share of the bar; anything up to 1 gives the same answers.
LEFT_OUT = 0.3
# Blocks of questions that are answered by scans at most.
MOST_SCANS = 16
ROW_GROUP = 16 << 20
# Of index files, which are read seldom and not fully, for which Snappy needs up to twice the bytes.
CODEC = "zstd"
# A row's number is its segment, shifted by so many bits, and its place in the segment: 8,000 segments of 100,000 tasks each.
PLACE_BITS = 50
# Hashes of ids are cut to so many: a bit for each is 1 MB.
HASHES = 1 << 23


def idf(documents: Column, frequency: Column) -> Column:
    return F.log(1 + (documents - frequency + 0.5) / (frequency + 0.5))


def saturation(tf: Column, n_terms: Column, mean: Column | float) -> Column:
    """What a posting counts for, without its term's weight. It grows with ``tf`` and falls with ``n_terms``."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * n_terms / (mean if isinstance(mean, Column) else F.lit(mean))))


def index_terms(chunks: DataFrame, id_col: str = "chunk_id", text: str = "chunk_to_embed") -> DataFrame:
    """One row per chunk: id, document, ``terms`` (term, tf) and ``n_terms``. Needs no shuffle and runs on streams."""
    return chunks.select(id_col, "path", term_counts(tokens(F.col(text))).alias("terms")).withColumn(
        "n_terms", F.aggregate("terms", F.lit(0).cast("long"), lambda total, t: total + t["tf"])
    )


def rank_hits(hits: DataFrame, k: int, id_col: str) -> DataFrame:
    """The best ``k`` hits per question with their rank; equal scores are ordered by id.

    Spark cuts each partition to ``k`` rows per question before the shuffle.
    """
    if k < 1:
        raise ValueError("k must be at least 1")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def is_one_of(column: str, values: list[str] | list[int]) -> Column:
    """A filter that reaches the scan. Written as text: as single literals, thousands would take seconds to hand over."""
    if not values:
        return F.lit(False)
    quoted = [v if isinstance(v, int) else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values]
    return F.expr(f"{column} IN ({', '.join(map(str, quoted))})")


def with_bit(rows: DataFrame, number: Column, numbers: DataFrame, there: bool = True) -> DataFrame:
    """The rows whose ``number`` is in the only column of ``numbers`` (positive), or, if not ``there``, is not.

    Each number is a bit in a row of 32,768 that lie together, so a million numbers that do take about 125 KB of a broadcast, and ``rows`` are not shuffled for them.
    """
    name = numbers.columns[0]
    held = numbers.groupBy(F.bitmap_bucket_number(name).alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(name)).alias("_bits"))
    given = rows.withColumns({"_bucket": F.bitmap_bucket_number(number), "_bit": F.bitmap_bit_position(number)})
    byte = "cast(conv(hex(substring(_bits, cast(_bit div 8 as int) + 1, 1)), 16, 10) as int)"
    found = F.expr(f"coalesce(shiftright({byte}, cast(_bit % 8 as int)) & 1, 0)") == int(there)
    return lookup_join(given, held, ["_bucket"], "left", spread=1).filter(found).select(*rows.columns)


class KeywordIndex:
    """Tables in one folder, each with a partition per sync (``segment``):

    - ``forward``: a row per chunk that was added: a number ``no``, id, ``path``, ``digest`` of its text, ``terms`` and ``n_terms``; in order of ``no``
    - ``blocks``: the postings of these rows, up to ``BLOCK`` of one term in a row, those that count most first, with the largest ``tf`` and
      smallest ``n_terms`` among them, and their number ``chunks``; in order of term, so that a scan can skip terms nobody asks for, and a frequent term is many rows
    - ``gone``: numbers of rows in earlier segments that no longer count
    - ``counts``: by how many chunks a term's number of chunks went up or down
    - ``totals``: the same for all chunks and their lengths. Written last: a segment without it does not count, and is written anew.

    A sync reads only ids and digests of what is there, and writes only what changed; no file of earlier syncs is touched. Counts
    and lengths are sums over the segments, so scores are exactly those of an index built at once.
    """

    def __init__(self, spark: SparkSession, path: str, id_col: str = "chunk_id"):
        self.spark, self.path, self.id_col = spark, path.rstrip("/"), id_col

    def segments(self) -> list[int]:
        jvm = self.spark.sparkContext._jvm
        marks = jvm.org.apache.hadoop.fs.Path(f"{self.path}/totals/segment=*/_SUCCESS")
        fs = marks.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(marks) or [])

    def _schema(self, name: str) -> T.StructType:
        return T._parse_datatype_string(
            {
                "forward": f"no long, {self.id_col} string, path string, digest string, terms array<struct<term:string,tf:int>>, n_terms int",
                "blocks": "term string, max_tf int, min_terms int, chunks int, postings array<struct<no:long,tf:int,n_terms:int>>",
                "gone": "no long",
                "counts": "term string, chunks long",
                "totals": "chunks long, n_terms long",
            }[name]
        )

    def _read(self, name: str) -> DataFrame:
        known = self.segments()
        if not known:
            raise ValueError(f"{self.path} has no finished segment")
        schema = T.StructType([*self._schema(name).fields, T.StructField("segment", T.IntegerType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").filter(F.col("segment").isin(known))

    def _write(self, df: DataFrame, name: str, segment: int) -> DataFrame:
        path = f"{self.path}/{name}/segment={segment}"
        schema = self._schema(name)
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        writer = rows.write.mode("overwrite").option("parquet.block.size", ROW_GROUP).option("compression", CODEC)
        writer.option("parquet.enable.dictionary#postings.list.element.no", "false").parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    # --- writing ---------------------------------------------------------------------------------------------------

    def _rows(self, chunks: DataFrame, text: str) -> DataFrame:
        digest = chunks.select(self.id_col, "path", text, F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
        terms = term_counts(tokens(F.coalesce(F.col(text), F.lit(""))))
        return digest.select(self.id_col, "path", "digest", terms.alias("terms")).withColumn(
            "n_terms", F.aggregate("terms", F.lit(0).cast("long"), lambda total, t: total + t["tf"])
        )

    def sync(self, chunks: DataFrame, text: str = "chunk_to_embed") -> bool:
        """Bring the index to the state of ``chunks`` (id, ``path`` and ``text``), whose ids are unique. False if nothing changed.

        A change of text or of ``path`` makes a chunk a new one. Nulls in the text count as empty.
        """
        known = self.segments()
        if not known:
            self._add(1, self._rows(chunks, text), None)
            return True
        state = F.md5(F.concat_ws("\x01", "digest", "path"))
        new = chunks.select(self.id_col, "path", F.md5(F.coalesce(F.col(text), F.lit(""))).alias("digest"))
        before = self.live().select("no", F.col(self.id_col).alias("_was"), state.alias("_old"))
        after = new.select(F.col(self.id_col).alias("_is"), state.alias("_new"))
        changed = before.join(after, F.col("_was") == F.col("_is"), "full_outer").filter(~F.col("_old").eqNullSafe(F.col("_new")))
        changed = written(changed.select("no", "_is"), "changed")
        if not changed.head(1):
            return False
        came = changed.filter("_is is not null").select(F.col("_is").alias(self.id_col))
        # Beyond a small broadcast all texts would be shuffled; a bit of the id's hash keeps back nearly all that did not change.
        hashed = F.pmod(F.xxhash64(self.id_col), F.lit(HASHES))
        likely = with_bit(chunks, hashed, came.select(hashed.alias("n")))
        rows = self._rows(lookup_join(likely, came, [self.id_col], "left_semi", spread=1), text)
        self._add(known[-1] + 1, rows, changed.filter("no is not null").select("no"))
        return True

    def remove(self, keys: DataFrame, column: str = "path") -> None:
        """Take out all chunks whose ``column`` is in the only column of ``keys``."""
        wanted = keys.select(F.col(keys.columns[0]).alias(column)).distinct()
        gone = lookup_join(self.live().select("no", column), wanted, [column], "left_semi", F.col("no"))
        self._add(self.segments()[-1] + 1, self.live().limit(0).drop("no", "segment"), written(gone.select("no"), "gone"))

    def _add(self, segment: int, added: DataFrame, gone: DataFrame | None) -> None:
        number = F.lit(segment << PLACE_BITS) + F.monotonically_increasing_id()
        added = self._write(added.withColumn("no", number), "forward", segment)
        signed, lost = added.select(F.lit(1).alias("sign"), "n_terms"), None
        if gone is None:
            gone = self.spark.range(0).select(F.col("id").alias("no"))
        else:
            lost = written(with_bit(self._read("forward"), F.col("no"), gone).select("terms", "n_terms"), "lost")
            signed = signed.unionByName(lost.select(F.lit(-1).alias("sign"), "n_terms"))
        # Postings are brought together by term before they are shuffled, so that blocks are, and not single postings. They are written, as the
        # bounds of the ranges are looked for first, which would make them twice.
        schema = "term string, max_tf int, min_terms int, chunks int, first long, packed binary"
        inverted = new_path(self.spark, "inverted")
        blocks = written_to(inverted, added.select("no", "n_terms", "terms").mapInArrow(scoring.inverter(BLOCK, 2_000_000, packed=True), schema), CODEC)
        order = ["term", F.desc("max_tf"), "min_terms", "first"]
        ordered = blocks.repartitionByRange(*order).sortWithinPartitions(*order)
        blocks = self._write(ordered.mapInArrow(scoring.block_merger(BLOCK), self._schema("blocks")), "blocks", segment)
        counts = blocks.select("term", F.col("chunks").alias("sign"))
        if lost is not None:
            counts = counts.unionByName(lost.select(F.explode("terms.term").alias("term"), F.lit(-1).alias("sign")))
        counts = counts.groupBy("term").agg(F.sum("sign").alias("chunks"))
        self._write(counts.repartitionByRange("term").sortWithinPartitions("term"), "counts", segment)
        self._write(gone, "gone", segment)
        length = F.col("sign") * F.col("n_terms")
        total = signed.agg(F.coalesce(F.sum("sign"), F.lit(0)).alias("chunks"), F.coalesce(F.sum(length), F.lit(0)).alias("n_terms"))
        self._write(total, "totals", segment)
        del ordered, counts
        release(self.spark, inverted)

    # --- reading ---------------------------------------------------------------------------------------------------

    def _counting(self, rows: DataFrame) -> DataFrame:
        """Of rows with ``no``, those of chunks that were not taken out or replaced later."""
        if len(self.segments()) == 1:
            return rows
        return with_bit(rows, F.col("no"), self._read("gone").select("no"), there=False)

    def live(self) -> DataFrame:
        """A row per chunk of the index: ``no``, id, ``path``, ``digest``, ``terms``, ``n_terms`` and ``segment``."""
        return self._counting(self._read("forward"))

    def totals(self) -> tuple[int, float]:
        """The number of chunks and their mean length."""
        row = self._read("totals").agg(F.sum("chunks"), F.sum("n_terms")).first()
        return row[0], row[1] / row[0] if row[0] and row[1] else 1.0

    def frequencies(self) -> DataFrame:
        """``term, frequency``: in how many chunks each term is."""
        counts = self._read("counts").withColumnRenamed("chunks", "frequency")
        if len(self.segments()) > 1:
            counts = counts.groupBy("term").agg(F.sum("frequency").alias("frequency"))
        return counts.select("term", "frequency").filter("frequency > 0")

    def top_k(self, questions: DataFrame, k: int) -> DataFrame:
        """The ``k`` chunks of highest BM25 score for each question: ``query_id, id, score, rank``.

        ``questions`` has ``query_id`` and ``terms``; a question in several rows asks for all their terms. All questions are
        answered at once, and stay a table. The postings of a question's rarest terms give its k-th best score so far, the bar. Terms that cannot reach
        the bar together find nothing by themselves, and of other terms only blocks are opened that could reach it with all the question's
        other terms. Chunks that could still be among the best are scored in full from their own terms. None that is among them is left out.
        Many long questions ask for more postings than there are, each of them several times; then all chunks are scored from their own terms where they lie.
        """
        documents, mean = self.totals()
        asked = written(questions.select("query_id", F.explode("terms.term").alias("term")).distinct(), "asked")
        names = [r[0] for r in asked.select("term").distinct().limit(PUSHED + 1).collect()]
        # Everything that is known per question and term has at most as many rows as were asked.
        small = is_small(asked)

        def of_asked(df: DataFrame) -> DataFrame:
            if len(names) <= PUSHED:
                return df.filter(is_one_of("term", names))
            terms = asked.select("term").distinct()
            return df.join(F.broadcast(terms) if small else terms, "term", "left_semi")

        def joined(big: DataFrame, terms: DataFrame, on: list[str], spread_by: Column) -> DataFrame:
            return big.join(F.broadcast(terms), on) if small else lookup_join(big, terms, on, spread_by=spread_by)

        known = written(asked.join(of_asked(self.frequencies()), "term"), "known")
        if self._pays_to_scan(known):
            return self._scan(known.withColumn("idf", idf(F.lit(documents), F.col("frequency"))), mean, k)
        bound = saturation(F.col("max_tf"), F.col("min_terms"), mean)
        tops = of_asked(self._read("blocks").select("term", "max_tf", "min_terms")).groupBy("term").agg(F.max(bound).alias("top"))
        weights = known.join(tops, "term").select(
            "query_id", "term", "frequency", idf(F.lit(documents), F.col("frequency")).alias("idf"), "top"
        )
        weights = weights.withColumn("most", F.col("idf") * F.col("top"))
        own = Window.partitionBy("query_id")
        earlier = own.orderBy(F.desc("most"), "term").rowsBetween(Window.unboundedPreceding, -1)
        upto = own.orderBy("most", "term").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        weights = written(
            weights.withColumns(
                {
                    "first": F.coalesce(F.sum("frequency").over(earlier), F.lit(0)) < FIRST_READ * k,
                    "total": F.sum("most").over(own),
                    "reach": F.sum("most").over(upto),
                }
            ),
            "weights",
        )

        def found(terms: DataFrame, could: Column | None = None) -> DataFrame:
            """``query_id, no, part``: sums over the postings of ``terms``, in the blocks that ``could`` matter."""
            blocks = of_asked(self._read("blocks"))
            opened = joined(blocks, terms, ["term"], F.xxhash64("max_tf", "min_terms", F.size("postings")))
            opened = opened.filter(could) if could is not None else opened
            kept = [c for c in terms.columns if c != "term"]
            rows = opened.select(*kept, F.inline("postings"))
            part = F.col("idf") * saturation(F.col("tf"), F.col("n_terms"), mean)
            return self._counting(rows).groupBy("query_id", "no").agg(F.sum(part).alias("part"))

        best = found(weights.filter("first").select("query_id", "term", "idf")).withColumnRenamed("part", "score")
        bars = rank_hits(best, k, "no").groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) == k, F.min("score") - SLACK).alias("bar")
        )
        bars = written(bars, "bars")
        told = weights.join(bars, "query_id", "left").withColumn("bar", F.coalesce("bar", F.lit(0.0)))
        # The fewer terms are left out, the nearer the sums of the others are to the scores.
        out = F.col("reach") < F.col("bar") * LEFT_OUT
        rest = told.filter(out).groupBy("query_id").agg(F.max("reach").alias("rest"))
        needed = told.filter(~out).select("query_id", "term", "idf", F.col("total") - F.col("most") + SLACK, "bar")
        needed = needed.toDF("query_id", "term", "idf", "others", "bar")
        def open_yet(sums: DataFrame, bar: DataFrame) -> DataFrame:
            """Those whose sum and the terms that were left out could reach the question's bar, if it has one."""
            limits = bar.join(rest, "query_id", "left").select("query_id", (F.col("bar") - F.coalesce("rest", F.lit(0.0))).alias("least"))
            limits = F.broadcast(limits) if small else limits
            return sums.join(limits, "query_id", "left").filter("least is null or part >= least").drop("least")

        parts = found(needed, F.col("idf") * bound + F.col("others") >= F.col("bar"))
        parts = written(open_yet(parts, bars), "parts")
        # These sums are nearly whole, so their k-th best is a far better bar.
        better = rank_hits(parts.withColumnRenamed("part", "score"), k, "no").groupBy("query_id").agg(
            F.when(F.count(F.lit(1)) == k, F.min("score") - SLACK).alias("bar")
        )
        candidates = open_yet(parts, better).select("query_id", "no")
        candidates = written(candidates, "candidates")
        few = [r[0] for r in candidates.select("no").limit(PUSHED + 1).collect()]
        forward = self._read("forward").select("no", self.id_col, "terms", "n_terms")
        if len(few) <= PUSHED:
            rows = forward.filter(is_one_of("no", sorted(set(few)))).join(F.broadcast(candidates), "no")
        else:
            # A number is in one row of the index, so nothing needs to be spread.
            rows = lookup_join(with_bit(forward, F.col("no"), candidates.select("no")), candidates, ["no"], spread=1)
        terms = rows.select("query_id", self.id_col, "n_terms", F.inline("terms"))
        weighted = joined(terms, weights.select("query_id", "term", "idf"), ["query_id", "term"], F.col(self.id_col))
        part = F.col("idf") * saturation(F.col("tf"), F.col("n_terms"), mean)
        scores = weighted.groupBy("query_id", self.id_col).agg(F.round(F.sum(part), scoring.ROUND).alias("score"))
        return rank_hits(scores.filter("score > 0"), k, self.id_col)

    def _pays_to_scan(self, known: DataFrame) -> bool:
        """True when the questions (``query_id, term, frequency``) ask for more postings than the scans they need would read."""
        from millrace.operators import search  # which imports this module

        asked = known.agg(F.sum("frequency"), F.count_distinct("query_id"), F.count_distinct("term")).first()
        scans = max(-(-asked[1] // search.BLOCK_QUERIES), -(-asked[1] * asked[2] // search.BLOCK_CELLS))
        if not asked[0] or scans > MOST_SCANS or asked[0] < scans * (self._read("counts").agg(F.sum("chunks")).first()[0] or 0):
            return False
        # Ids should be unique; where they are not, their rows are added up by the other way.
        same = self.live().groupBy(F.xxhash64(self.id_col)).count().agg(F.max("count")).first()[0]
        return (same or 0) <= 1

    def _scan(self, weights: DataFrame, mean: float, k: int) -> DataFrame:
        """The same answers by one pass over the terms of all chunks. Nothing but the best ``k`` of each task is shuffled."""
        from millrace.operators import search

        entries = F.transform(
            "terms", lambda t: F.struct(t["term"].alias("key"), saturation(t["tf"], F.col("n_terms"), mean).alias("weight"))
        )
        asked = weights.select("query_id", F.col("term").alias("key"), F.col("idf").alias("weight"))
        return search.sparse_top_k(self.live(), self.id_col, entries, asked, k)
