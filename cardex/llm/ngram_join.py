"""Operator 10: documents linked by the Jaccard similarity of their word n-grams.

The n-grams' hashes are cut into fragments; the global order is by fragment, then by
frequency, then by hash.  Equal sets are one class from the start.

1. Screening.  Two sets that link share one of the first n-grams (their prefixes) in
   any global order, and a prefix nearly always ends in the first fragment.  So only
   that fragment's n-grams are counted in the corpus, and classes whose prefixes have
   nothing in common with another class are done.
2. Of the classes left, all n-grams are counted.  Prefixes in the order of frequency,
   bounds on length and position give the candidate pairs.
3. A pair's overlap is counted in each fragment on its own and summed per pair.

Within a list of classes that share an n-gram, every class is first compared with the
list's most central one.  What these links connect needs no further comparison within
itself; all remaining pairs, between different components, are compared after that.
So a large group of near copies costs a comparison or two for each, and no link
between components is lost.  That is enough for ``ngram_components``; ``ngram_join``
and ``ngram_links`` compare all candidate pairs and return or count every link.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardex.llm.common import SPACE_CLASS, ascii_lower, discard, let, store, words_sql
from cardex.llm.components import components

NGRAM = 4
# Least similarity as a fraction: numerator, denominator.
SIMILARITY = (85, 100)
# Bits of a hash that name its fragment.
FRAGMENT_BITS = 2
# Rows of 8 bytes that may be broadcast; more of them join by a shuffle.
BROADCAST_ROWS = 200_000
# Classes of one list that a block holds; the pairs of two blocks are made together.
BLOCK = 500

WORD = rf"[^{SPACE_CLASS}]+"


def set_sql(text: str, n: int) -> str:
    """SQL ARRAY<BIGINT>: sorted hashes of a text's distinct n-grams.

    A text of fewer words is one n-gram, a text without words none.
    """
    gram = ", ".join(f"w[i + {k}]" if k else "w[i]" for k in range(n))
    grams = f"transform(sequence(0, size(w) - {n}), i -> xxhash64({gram}))"
    body = (
        f"if(size(w) = 0, cast(array() as array<bigint>), if(size(w) < {n}, array(xxhash64(w)),"
        f" sort_array(array_distinct({grams}))))"
    )
    return let("w", words_sql(ascii_lower(text), WORD), body)


def _fragment(value: str) -> str:
    return f"shiftright({value}, {64 - FRAGMENT_BITS})"


def _prefix(n: str, similarity: tuple[int, int]) -> str:
    """SQL: how many of a set's first n-grams a linked set must meet."""
    num, den = similarity
    return f"({n} - cast(({num}L * {n} + {den - 1}) div {den} as int) + 1)"


def _classes(documents: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """Per row ``_id, _n, _first, _second, _set``; the middle three identify its class."""
    return (
        documents.select(F.col(id_col).alias("_id"), F.expr(f"{set_sql(text_col, n)} as _set"))
        .select(
            "_id",
            F.expr("size(_set) as _n"),
            F.expr("xxhash64(_set) as _first"),
            F.expr("xxhash64('second', _set) as _second"),
            "_set",
        )
    )


CLASS = ["_n", "_first", "_second"]
# A measure of stored frames.
ROWS = {"rows": "count(1)"}


def _small(frame: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """The frame, stored with its ``ROWS``, to be broadcast if it has no more than ``rows``."""
    return F.broadcast(frame) if frame.measures["rows"] <= rows else frame


def _screened(rows: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``_first``: hashes of the classes whose prefix meets another class's prefix.

    Counts are partially aggregated; an n-gram of a third of all classes is one row
    per task.  A chance collision of hashes only lets a class through in vain.
    """
    spark = rows.sparkSession
    last = f"get(_set, {_prefix('_n', similarity)} - 1)"
    # conditions on what is aggregated: others Spark would move below the hashing of
    # n-grams, which would then run twice
    heads = store(
        spark,
        rows.select(*CLASS, F.expr(f"filter(_set, h -> {_fragment('h')} <= {_fragment(last)}) as _head"))
        .groupBy(*CLASS)
        .agg(F.first("_head").alias("_head"))
        .where(F.size("_head") > 0),
        "heads",
    )
    tokens = heads.select("_n", "_first", F.expr("explode_outer(_head) as _gram"))
    shared = store(
        spark,
        tokens.groupBy("_gram").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1").select("_gram"),
        "shared",
        **ROWS,
    )
    # places in the order: in every fragment the unshared n-grams come first
    met = (
        tokens.withColumn("_fragment", F.expr(_fragment("_gram")))
        .join(_small(shared), "_gram", "left_semi")
        .groupBy("_first", "_n", "_fragment")
        .agg(F.count(F.lit(1)).alias("_met"))
    )
    own = heads.select(
        "_first",
        "_n",
        F.expr(
            f"explode_outer(transform(array_distinct(transform(_head, h -> {_fragment('h')})),"
            f" f -> named_struct('f', f, 'upto', size(filter(_head, h -> {_fragment('h')} <= f))))) as _cut"
        ),
    ).select("_first", "_n", F.col("_cut.f").alias("_fragment"), F.col("_cut.upto").alias("_upto"))
    found = met.join(own, ["_first", "_n", "_fragment"]).where(f"_upto - _met < {_prefix('_n', similarity)}")
    screened = store(spark, found.select("_first", "_n").distinct(), "screened")
    discard(heads, shared)
    return screened


def _postings(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``_gram, c, n, place``: the prefixes of ``sets(c, n, _set)`` in order of frequency.

    Only n-grams of at least two prefixes are of use, so only those are kept.
    """
    spark = sets.sparkSession
    tokens = sets.select("c", "n", F.expr("explode_outer(_set) as _gram"))
    counts = store(
        spark,
        tokens.groupBy("_gram").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1"),
        "counts",
        **ROWS,
    )
    by_class = Window.partitionBy("c")
    ordered = by_class.orderBy("_count", "_gram")
    prefixes = store(
        spark,
        tokens.join(_small(counts), "_gram")
        .withColumn("place", F.col("n") - F.count(F.lit(1)).over(by_class) + F.row_number().over(ordered) - 1)
        .where(f"place < {_prefix('n', similarity)}")
        .select("_gram", "c", "n", F.col("place").cast("int").alias("place")),
        "prefixes",
    )
    useful = prefixes.groupBy("_gram").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1")
    postings = store(spark, prefixes.join(useful.select("_gram"), "_gram", "left_semi"), "postings")
    discard(counts, prefixes)
    return postings


def _may_link(similarity: tuple[int, int]) -> str:
    """SQL over the sides x, y of a pair at a shared n-gram: the bounds on sizes and places.

    At the first n-gram that a linked pair shares, what follows on either side is
    enough for the overlap it needs; so at one n-gram at least the condition holds.
    """
    num, den = similarity
    return (
        f"{num}L * greatest(x.n, y.n) <= {den}L * least(x.n, y.n)"
        f" and least(x.n - x.place, y.n - y.place) * {num + den}L >= {num}L * (x.n + y.n)"
    )


def _star_pairs(postings: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b``: in every list, the most central class with each other one that may link."""
    central = postings.groupBy("_gram").agg(
        F.min(F.struct((F.col("place") / F.col("n")).alias("share"), F.col("c"), F.col("n"), F.col("place"))).alias("x")
    )
    return (
        postings.alias("y")
        .join(central.select("_gram", "x"), "_gram")
        .where(f"x.c <> y.c and {_may_link(similarity)}")
        .select(F.expr("least(x.c, y.c) as a"), F.expr("greatest(x.c, y.c) as b"))
        .distinct()
    )


def _marked(postings: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings with the component that each class is in by now."""
    joined = postings.join(labels.withColumnRenamed("node", "c"), "c", "left").select(
        "_gram", "c", "n", "place", F.coalesce("component", "c").alias("component")
    )
    return store(postings.sparkSession, joined, "marked")


def _cross_pairs(marked: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b``: all pairs of a list that may link and are in different components.

    Sizes are joined by classes of their logarithm, as a pair's sizes lie within a
    factor; lists whose classes are all of one component drop out first.  Long lists are
    dealt into blocks, as in ``_all_pairs``.
    """
    num, den = similarity
    mixed = (
        marked.groupBy("_gram")
        .agg(
            F.min("component").alias("_low"),
            F.max("component").alias("_high"),
            F.expr(f"cast(ceil(count(1) / {BLOCK}) as int) as _blocks"),
        )
        .where("_low <> _high")
        .select("_gram", "_blocks")
    )
    classes = f"cast(floor(ln(n) / ln({den}D / {num}D)) as int)" if num < den else "n"
    dealt = (
        marked.join(mixed, "_gram")
        .withColumn("size_class", F.expr(classes))
        .withColumn("_mine", F.expr("cast(pmod(xxhash64(c), _blocks) as int)"))
    )
    others = F.expr("explode(sequence(0, _blocks - 1))")
    left = dealt.withColumn("_block", F.col("_mine")).withColumn("_other", others)
    right = dealt.withColumn("_block", others).withColumn("_other", F.col("_mine"))
    # the larger of a pair is at most one size class above; rounding may add another
    right = right.withColumn("size_class", F.explode(F.array(*(F.col("size_class") + k for k in (0, -1, -2)))))
    return (
        left.alias("x")
        .join(right.alias("y"), ["_gram", "size_class", "_block", "_other"])
        .where("x.component <> y.component and (x.n < y.n or x.n = y.n and x.c < y.c)")
        .where(_may_link(similarity))
        .select(F.expr("least(x.c, y.c) as a"), F.expr("greatest(x.c, y.c) as b"))
        .distinct()
    )


def _all_pairs(postings: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b``: all pairs of a list that may link.

    Lists are dealt by hash into blocks, and a task joins two blocks of one list, so a
    list of any length makes tasks of at most about ``BLOCK`` times ``BLOCK`` pairs.
    """
    lists = postings.groupBy("_gram").agg(F.expr(f"cast(ceil(count(1) / {BLOCK}) as int) as _blocks"))
    dealt = store(
        postings.sparkSession,
        postings.join(lists, "_gram").withColumn("_block", F.expr("cast(pmod(xxhash64(c), _blocks) as int)")),
        "dealt",
    )
    others = F.expr("explode(sequence(0, _blocks - 1))")
    left = dealt.withColumn("_other", others)
    right = dealt.withColumn("_mine", F.col("_block")).withColumn("_block", others).withColumnRenamed("_mine", "_other")
    pairs = store(
        postings.sparkSession,
        left.alias("x")
        .join(right.alias("y"), ["_gram", "_block", "_other"])
        .where("(x.n < y.n or x.n = y.n and x.c < y.c)")
        .where(_may_link(similarity))
        .select(F.expr("least(x.c, y.c) as a"), F.expr("greatest(x.c, y.c) as b"))
        .distinct(),
        "pairs",
    )
    discard(dealt)
    return pairs


def _overlaps(pairs: DataFrame, segments: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b, _overlap`` of pairs that link: counted per fragment and summed per pair."""
    num, den = similarity
    left = segments.select(F.col("c").alias("a"), F.col("n").alias("n_a"), "_fragment", F.col("_grams").alias("_left"))
    right = segments.select(F.col("c").alias("b"), F.col("n").alias("n_b"), "_fragment", F.col("_grams").alias("_right"))
    return (
        pairs.join(left, "a")
        .join(right, ["b", "_fragment"])
        .select("a", "b", "n_a", "n_b", F.expr("size(array_intersect(_left, _right)) as _partial"))
        .groupBy("a", "b", "n_a", "n_b")
        .agg(F.sum("_partial").alias("_overlap"))
        .where(f"{den}L * _overlap >= {num}L * (n_a + n_b - _overlap)")
        .select("a", "b", "_overlap")
    )


def _verified(pairs: DataFrame, segments: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``a, b`` that link."""
    return _overlaps(pairs, segments, similarity).select("a", "b")


def _segments(sets: DataFrame) -> DataFrame:
    """``c, n, _fragment, _grams``: the sets of ``sets(c, n, _set)`` cut into fragments."""
    return sets.select(
        "c",
        "n",
        F.expr(
            f"explode_outer(transform(array_distinct(transform(_set, h -> {_fragment('h')})),"
            f" f -> named_struct('f', f, 'grams', filter(_set, h -> {_fragment('h')} = f)))) as _segment"
        ),
    ).select("c", "n", F.col("_segment.f").alias("_fragment"), F.col("_segment.grams").alias("_grams"))


def _class_links(sets: DataFrame, similarity: tuple[int, int]) -> DataFrame:
    """``node, component`` over the classes ``sets(c, n, _set)`` that have links."""
    spark = sets.sparkSession
    postings = _postings(sets, similarity)
    segments = _segments(sets)
    star = store(spark, _star_pairs(postings, similarity), "star")
    links = store(spark, _verified(star, segments, similarity), "links")
    labels = components(links)
    marked = _marked(postings, labels)
    rest = _cross_pairs(marked, similarity).join(star, ["a", "b"], "left_anti")
    more = store(spark, _verified(rest, segments, similarity), "links", **ROWS)
    discard(marked, postings, star, links)
    if not more.measures["rows"]:
        return labels
    joined = labels.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
    return components(joined)


def _screened_sets(
    documents: DataFrame, id_col: str, text_col: str, n: int, similarity: tuple[int, int]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Members (``_id`` and class), classes with their smallest ``_id``, and the sets
    ``c, n, _first, _second, _set`` of the classes that may have links."""
    spark = documents.sparkSession
    rows = _classes(documents, id_col, text_col, n)
    members = store(spark, rows.select("_id", *CLASS), "members")
    screened = _screened(rows, similarity)
    classes = members.where("_n > 0").groupBy(*CLASS).agg(F.min("_id").alias("_id"))
    wanted = store(spark, classes.join(screened, ["_first", "_n"], "left_semi"), "wanted", **ROWS)
    ids = wanted.select(F.col("_id").alias("_wanted")).distinct()
    ids.measures = wanted.measures  # its rows at most
    chosen = documents.select(F.col(id_col).alias("_source"), F.col(text_col).alias("_text")).join(
        _small(ids), F.col("_source").eqNullSafe(F.col("_wanted")), "left_semi"
    )
    sets = store(
        spark,
        _classes(chosen, "_source", "_text", n)
        .groupBy(*CLASS)
        .agg(F.first("_set").alias("_set"))
        .where(F.size("_set") > 0)
        .select(F.monotonically_increasing_id().alias("c"), F.col("_n").alias("n"), "_first", "_second", "_set"),
        "sets",
    )
    discard(screened, wanted)
    return members, classes, sets


def ngram_components(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = NGRAM,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """``id_col, n_shingles, component_id`` for every document.

    ``component_id`` is the smallest id among the documents reachable by links, the
    document's own included.  Documents with equal sets are linked; documents with NULL,
    empty or wordless text have no n-grams and are linked with nothing.  A NULL id is
    never the smallest unless the component has no other.  Repeated rows each get their
    row; other columns are ignored; an empty table gives an empty result.
    """
    spark = documents.sparkSession
    members, classes, sets = _screened_sets(documents, id_col, text_col, n, similarity)
    labels = _class_links(sets.select("c", "n", "_set"), similarity)
    named = store(
        spark,
        sets.select("c", F.col("n").alias("_n"), "_first", "_second")
        .join(labels.withColumnRenamed("node", "c"), "c")
        .select(*CLASS, F.col("component").alias("_component")),
        "named",
    )
    discard(sets)
    by_component = (
        named.join(classes, CLASS).groupBy("_component").agg(F.min("_id").alias("_smallest"))
    )
    smallest = classes.join(named.join(by_component, "_component"), CLASS, "left").select(
        *CLASS, F.coalesce("_smallest", "_id").alias("_smallest")
    )
    return members.join(smallest, CLASS, "left").select(
        F.col("_id").alias(id_col),
        F.col("_n").cast("bigint").alias("n_shingles"),
        F.coalesce("_smallest", "_id").alias("component_id"),
    )


def ngram_join(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = NGRAM,
    similarity: tuple[int, int] = SIMILARITY,
) -> tuple[DataFrame, DataFrame]:
    """Every link: the pairs of classes ``a, b, overlap`` and the members ``id_col, class``.

    Documents with equal sets are one class, ``STRUCT<n, first, second>`` with ``n`` the
    size of the set, and NULL without words.  Two documents are linked if their classes
    are equal or a pair; each pair of different classes is there once, with ``a < b`` and
    the number of n-grams that they share.  Members hold a row for every document's.
    """
    spark = documents.sparkSession
    members, _, sets = _screened_sets(documents, id_col, text_col, n, similarity)
    shapes = sets.select("c", "n", "_set")
    postings = _postings(shapes, similarity)
    pairs = _all_pairs(postings, similarity)
    links = store(spark, _overlaps(pairs, _segments(shapes), similarity), "links")
    names = sets.select(
        "c", F.struct("n", F.col("_first").alias("first"), F.col("_second").alias("second")).alias("_class")
    )
    ends = links.join(names.select(F.col("c").alias("a"), F.col("_class").alias("_x")), "a").join(
        names.select(F.col("c").alias("b"), F.col("_class").alias("_y")), "b"
    )
    found = store(
        spark,
        ends.select(
            F.least("_x", "_y").alias("a"), F.greatest("_x", "_y").alias("b"), F.col("_overlap").alias("overlap")
        ),
        "class_pairs",
    )
    discard(postings, pairs, links, sets)
    named = F.struct(F.col("_n").alias("n"), F.col("_first").alias("first"), F.col("_second").alias("second"))
    return found, members.select(F.col("_id").alias(id_col), F.when(F.col("_n") > 0, named).alias("class"))


def ngram_links(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = NGRAM,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """``id_col, n_shingles, n_links`` for every document: how many other rows it is linked with.

    Rows of equal sets count, repeated rows too; documents without words have no links.
    """
    pairs, members = ngram_join(documents, id_col, text_col, n, similarity)
    sizes = members.where("class is not null").groupBy("class").agg(F.count(F.lit(1)).alias("_size"))
    both = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = (
        both.join(sizes.withColumnRenamed("class", "b"), "b")
        .groupBy(F.col("a").alias("class"))
        .agg(F.sum("_size").alias("_others"))
    )
    linked = sizes.join(others, "class", "left").select(
        "class", (F.col("_size") - 1 + F.coalesce("_others", F.lit(0))).alias("_links")
    )
    return members.join(linked, "class", "left").select(
        id_col,
        F.coalesce(F.col("class.n"), F.lit(0)).cast("bigint").alias("n_shingles"),
        F.coalesce("_links", F.lit(0)).cast("bigint").alias("n_links"),
    )


def without_near_duplicates(
    documents: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    n: int = NGRAM,
    similarity: tuple[int, int] = SIMILARITY,
) -> DataFrame:
    """One row of every group of linked documents, with all columns.

    The one with the smallest id stays, NULL being greater than any; among texts of one
    id a hash of the text decides, and of rows equal in both any single one stays.
    Documents without words are linked with nothing and all stay, repeated rows too.
    """
    names = [f"_c{k}" for k in range(len(documents.columns))]
    id_name, text_name = (names[documents.columns.index(c)] for c in (id_col, text_col))
    rank = F.struct(
        F.col(id_name).isNull().alias("unknown"),
        F.coalesce(F.col(id_name), F.lit(0)).alias("id"),
        F.xxhash64(F.coalesce(F.col(text_name), F.lit(""))).alias("written"),
    )
    rows = documents.toDF(*names).withColumn("_rank", rank)
    found = ngram_components(rows.select("_rank", text_name), "_rank", text_name, n, similarity)
    winners = store(
        documents.sparkSession,
        found.where("_rank = component_id")
        .groupBy("_rank")
        .agg(((F.count(F.lit(1)) > 1) & (F.max("n_shingles") > 0)).alias("_again")),
        "winners",
        again="count_if(_again)",
    )
    left = rows.join(winners.where("not _again"), "_rank", "left_semi").select(names)
    again = winners.where("_again")
    if winners.measures["again"]:
        # rows equal in id and text win together: combined before they are shuffled
        several = rows.join(again, "_rank", "left_semi").dropDuplicates(["_rank"])
        left = left.unionByName(several.select(names))
    return left.toDF(*documents.columns)


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's columns of ``ngram_components`` over ``documents``."""
    return ngram_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP10_SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
gram AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) < 4 THEN [array_to_string(w, ' ')] ELSE
           [array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)] END) AS g
  FROM doc WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id),
link AS (
  SELECT o.a, o.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
    FROM gram x JOIN gram y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL) o
  JOIN sizes s ON s.doc_id = o.a JOIN sizes t ON t.doc_id = o.b
  WHERE 100 * o.o >= 85 * (s.n + t.n - o.o)),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, min(r.b) AS component_id
FROM doc d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reach r ON r.a = d.doc_id
GROUP BY ALL
"""
