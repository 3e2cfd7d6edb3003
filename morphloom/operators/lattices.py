"""From lattice text to one row per morpheme.

Everything on decoded responses works inside the row: arrays and generators, no
shuffle. Every operator keeps ``doc_order`` if the table has it.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from morphloom.functions import (
    int_or_null,
    line_fields,
    once,
    sentence_blocks,
    sentence_lines,
)
from morphloom.functions.text import _col
from morphloom.operators.checkpoints import materialize, store
from morphloom.operators.runs import as_lists, can_pack, pack, unpack
from morphloom.schemas import DEP_COLUMNS, MD_COLUMNS, key_columns, require_columns

# Rows of one sentence numbered in one window group; see with_token_id.
ROWS_PER_BLOCK = 100_000
_FAN = 1024  # blocks in a block of the next level, at least
_MOST_LONG = 100_000  # sentences of a broadcast list
# Sentences, and places in each, that are joined as one row; see attach_dependencies.
_SENTENCES_PER_BLOCK = 16
_PLACES_PER_BLOCK = 256
# Bytes of a piece of a lattice; see cut_lattices.
PIECE_BYTES = 4_000_000
_PIECES_PER_BATCH = 10_000
_BORDER = re.compile(b"\n\n+")


def _explode_lattice(
    df: DataFrame, col: str, names: Sequence[str], upto: int | None = None
) -> DataFrame:
    require_columns(df, "doc_id", col)
    keys = key_columns(df)
    # Pieces of one lattice go on numbering its sentences.
    before = ["sentence_offset"] if "sentence_offset" in df.columns else []
    kept = [*keys, *before]
    # The arrays are written inside the generators: on a column that holds the array,
    # Spark infers a "not empty" filter and builds the array once more for it.
    lines = df.select(*kept, F.posexplode(sentence_blocks(col)).alias("_s", "_block")).select(
        *kept, "_s", F.posexplode(sentence_lines("_block")).alias("_p", "_line")
    )
    # Each condition of a later filter would split the line again.
    rows = lines.select(*kept, "_s", "_p", once(line_fields("_line", upto)).alias("_f"))
    return rows.select(
        *keys,
        sum(map(F.col, before), F.col("_s") + 1).alias("sentence_id"),
        *[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(names[:upto])],
        (F.col("_p") + 1).alias("position"),
    )


def _pieces(text: pa.Buffer | None, width: int) -> Iterator[tuple[int, bytes | None]]:
    """(sentences before, piece) of a lattice cut at the borders behind ``width`` bytes."""
    if text is None or len(text) <= width:
        yield 0, None if text is None else text.to_pybytes()
        return
    view, start, before = memoryview(text), 0, 0
    while start < len(view):
        border = _BORDER.search(view, start + width)
        end = border.end() if border else len(view)
        piece = bytes(view[start:end]).strip(b"\n")
        if piece:
            yield before, piece
            before += 1 + sum(1 for _ in _BORDER.finditer(piece))
        start = end


def cut_lattices(
    df: DataFrame, col: str = "md_lattice", bytes_per_piece: int = PIECE_BYTES
) -> DataFrame:
    """Lattices in pieces of whole sentences: one row per piece, with ``sentence_offset``.

    For documents so long that the arrays of all their sentences would not fit in a
    task: :func:`explode_md` and :func:`explode_dep` decode a piece at a time and number
    its sentences from the offset on, so the rows are those of the whole lattice. A piece
    ends at the first sentence border behind ``bytes_per_piece`` bytes; a lattice that
    is not longer stays as it is. Pieces are rows like others: ``repartition`` them to
    have one long document decoded by several tasks. Other columns than the keys and the
    lattice are left out.

    The cut is made in Python workers, on Arrow buffers: SQL functions find the n-th
    character of a text by reading it from its start, once for every piece.
    """
    require_columns(df, "doc_id", col)
    if bytes_per_piece < 1:
        raise ValueError("bytes_per_piece must be 1 or more")
    keys = key_columns(df)
    rows = df.select(*keys, F.col(col).cast("binary").alias("_text"))

    def run(batches):
        for batch in batches:
            texts = batch.column("_text")
            # Pieces go on together, up to so many bytes: a batch of one short piece costs
            # many times what the cut does.
            source, pieces, offsets, held = [], [], [], 0

            def flush() -> pa.RecordBatch:
                place = pa.array(source, pa.int64())
                return pa.RecordBatch.from_arrays(
                    [
                        *(c.take(place) for c in batch.columns[:-1]),
                        pa.array(pieces, pa.binary()),
                        pa.array(offsets, pa.int32()),
                    ],
                    names=[*keys, "_text", "sentence_offset"],
                )

            for i in range(batch.num_rows):
                text = texts[i].as_buffer() if texts[i].is_valid else None
                for before, piece in _pieces(text, bytes_per_piece):
                    source.append(i)
                    pieces.append(piece)
                    offsets.append(before)
                    held += len(piece or b"")
                    if held >= PIECE_BYTES or len(source) >= _PIECES_PER_BATCH:
                        yield flush()
                        source, pieces, offsets, held = [], [], [], 0
            if source:
                yield flush()

    schema = T.StructType([*rows.schema, T.StructField("sentence_offset", T.IntegerType(), False)])
    return rows.mapInArrow(run, schema).select(
        *keys, "sentence_offset", F.col("_text").cast("string").alias(col)
    )


def explode_md(df: DataFrame, col: str = "md_lattice") -> DataFrame:
    """One row per lattice line: ``sentence_id``, eight string fields, ``position``.

    Short lines are filled with NULL, long ones cut. ``position`` is the line's
    1-based place in its sentence. Documents without lines give no row. With a column
    ``sentence_offset`` (:func:`cut_lattices`) sentences are numbered from it on.
    """
    return _explode_lattice(df, col, MD_COLUMNS)


def explode_dep(df: DataFrame, col: str = "dep_tree") -> DataFrame:
    """Like :func:`explode_md`, for dependency trees."""
    return _explode_lattice(df, col, DEP_COLUMNS)


def coerce_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Turn the named string columns that exist into integers; bad text is NULL."""
    present = {c: int_or_null(c) for c in cols if c in df.columns}
    return df.withColumns(present) if present else df


def morphemes(decoded: DataFrame, dependency: bool = False) -> DataFrame:
    """Decoded responses to the morpheme table.

    With ``dependency`` the rows of the dependency tree are put beside the lattice
    rows by their place in the sentence of the same number. Lattice rows beyond the
    tree get NULL, tree rows beyond the lattice are dropped.
    """
    if not dependency:
        return morpheme_table(explode_md(decoded))

    keys = key_columns(decoded)
    rows = (
        _sentence_pairs(decoded)
        .select(
            *keys,
            "_s",
            F.posexplode(
                _zip(sentence_lines("_md"), sentence_lines("_dep"))
            ).alias("_p", "_pair"),
        )
        .where(_left("_pair").isNotNull())
        # The tree first: a filter on a relation then comes before the lattice line is split.
        .select(*keys, "_s", "_p", "_pair", once(line_fields(_right("_pair"))).alias("_d"))
        .select(*keys, "_s", "_p", "_d", once(line_fields(_left("_pair"))).alias("_f"))
    )
    md = rows.select(
        *keys,
        (F.col("_s") + 1).alias("sentence_id"),
        *[F.get("_f", F.lit(i)).alias(n) for i, n in enumerate(MD_COLUMNS)],
        (F.col("_p") + 1).alias("position"),
        int_or_null(F.get("_d", F.lit(DEP_COLUMNS.index("head")))).alias("head"),
        F.get("_d", F.lit(DEP_COLUMNS.index("deprel"))).alias("deprel"),
    )
    return morpheme_table(md)


def content_morphemes(decoded: DataFrame) -> DataFrame:
    """The morpheme table up to ``pos``: all that counting needs, at half the cost."""
    require_columns(decoded, "doc_id", "md_lattice")
    upto = MD_COLUMNS.index("cpostag") + 1
    return _explode_lattice(decoded, "md_lattice", MD_COLUMNS, upto).select(
        *key_columns(decoded),
        "sentence_id",
        F.col("position").alias("token_id"),
        "token",
        "lemma",
        F.col("cpostag").alias("pos"),
    )


def _sentence_pairs(decoded: DataFrame) -> DataFrame:
    """One row per lattice sentence: its text and that of the same-numbered tree."""
    require_columns(decoded, "doc_id", "md_lattice", "dep_tree")
    keys = key_columns(decoded)
    return (
        decoded.select(
            *keys,
            F.posexplode(_zip(sentence_blocks("md_lattice"), sentence_blocks("dep_tree"))).alias(
                "_s", "_pair"
            ),
        )
        .where(_left("_pair").isNotNull())
        .select(*keys, "_s", _left("_pair").alias("_md"), _right("_pair").alias("_dep"))
    )


def _zip(left: Column, right: Column) -> Column:
    """Pairs by place, the shorter side filled with NULL; NULL only if ``left`` is."""
    return F.arrays_zip(left, F.coalesce(right, F.array().cast("array<string>")))


def _left(pair: str) -> Column:
    return F.col(pair).getField("0")


def _right(pair: str) -> Column:
    return F.col(pair).getField("1")


def morpheme_table(md: DataFrame) -> DataFrame:
    """Exploded (and possibly joined) lattice rows under the names of the morpheme
    table; lattice edges and word numbers are left out."""
    cols = [
        *[F.col(k) for k in key_columns(md)],
        F.col("sentence_id"),
        F.col("position").alias("token_id"),
        F.col("token"),
        F.col("lemma"),
        F.col("cpostag").alias("pos"),
        F.col("postag").alias("xpos"),
        F.col("feats"),
    ]
    if "head" in md.columns:
        cols += [F.col("head").alias("head_token_id"), F.col("deprel")]
    return md.select(*cols)


def attach_dependencies(md: DataFrame, dep: DataFrame, co_located: bool = False) -> DataFrame:
    """Join two exploded tables by document, sentence and position.

    For lattices and trees that are stored apart; when both are in one response,
    :func:`morphemes` does the same without a shuffle. Documents that share a
    ``doc_id`` need ``doc_order`` on both sides: a tree row whose place is taken
    twice stops the job, since every copy would be joined with every other.

    ``co_located`` says that both are tables of :func:`store_by_sentence` with as many
    buckets each: then no row is shuffled, if ``spark.sql.requireAllClusterKeysForCoPartition``
    is ``false``, as buckets are by sentence and the join is by place. The result is the
    same whatever the tables are.

    Otherwise both are shuffled as runs of neighbouring rows (:func:`pack`), and blocks of 16
    sentences and 256 places in each are joined, within which places are looked up.
    """
    keys = [k for k in key_columns(md) if k in dep.columns] + ["sentence_id", "position"]
    require_columns(md, *keys)
    require_columns(dep, *keys, "head", "deprel")
    if not co_located and all(can_pack(t) and _has_places(t) for t in (md, dep)):
        return _attach_runs(md, dep, keys)
    # One row per place. Places hardly repeat, so nothing is combined before the shuffle,
    # and the grouping and the join share its partitioning and sort order.
    placed = dep if co_located else dep.repartition(*keys)
    arcs = placed.groupBy(*keys).agg(
        F.first("head").alias("_head"),
        F.first("deprel").alias("_deprel"),
        F.count(F.lit(1)).alias("_n"),
    )
    # In both columns, as a query may read only one of them.
    repeated = F.col("_n") > 1
    head = F.when(repeated, _several_trees()).otherwise(F.col("_head").cast("string"))
    deprel = F.when(repeated, _several_trees()).otherwise(F.col("_deprel"))
    arcs = arcs.select(*keys, int_or_null(head).alias("head"), deprel.alias("deprel"))
    return md.join(arcs, keys, "left")


def _several_trees() -> Column:
    message = F.concat(F.lit("several trees for document "), F.coalesce("doc_id", F.lit("NULL")))
    return F.raise_error(message).cast("string")


def _has_places(df: DataFrame) -> bool:
    places = [df.schema[c].dataType for c in ("sentence_id", "position")]
    return all(isinstance(kind, T.IntegerType) for kind in places)


def _place() -> Column:
    """Sentence and position as one number."""
    return F.col("sentence_id").cast("bigint") * 2**32 + F.col("position")


def _attach_runs(md: DataFrame, dep: DataFrame, keys: Sequence[str]) -> DataFrame:
    """:func:`attach_dependencies`, with both sides shuffled as runs of a block of places."""
    blocks = [
        F.expr(f"sentence_id div {_SENTENCES_PER_BLOCK}").alias("_part"),
        F.expr(f"position div {_PLACES_PER_BLOCK}").alias("_block"),
    ]
    by = [*[k for k in keys if k not in ("sentence_id", "position")], "_part", "_block"]
    arcs = dep.select(
        *keys, *blocks, F.col("head").cast("string").alias("head"), F.col("deprel").cast("string").alias("deprel")
    )
    packed = pack(arcs, by).repartition(*by)
    # All runs of a block as one row of arrays: one run, unless its rows do not lie together.
    names = ("sentence_id", "position", "head", "deprel")
    lists = as_lists(packed, [arcs.schema[n] for n in names], by).groupBy(*by).agg(
        F.collect_list(F.struct(*names)).alias("_runs")
    )
    sentence, position, heads, deprels = (F.flatten(F.col("_runs")[n]) for n in names)
    places = F.zip_with(sentence, position, lambda s, p: s.cast("bigint") * 2**32 + p)
    taken = lists.select(*by, places.alias("_places"), heads.alias("_heads"), deprels.alias("_deprels"))
    # Places that are taken twice, which are looked for only where there are any.
    again = F.filter("_places", lambda p, i: F.array_position("_places", p) <= i)
    twice = F.size(F.array_distinct("_places")) < F.size("_places")
    taken = taken.withColumn("_again", F.when(twice, again))

    joined = pack(md.select("*", *blocks), by).join(taken, by, "left")
    rest = [f for f in md.schema if f.name not in by]
    rows = unpack(joined, rest, [*by, "_places", "_heads", "_deprels", "_again"])
    repeated = F.coalesce(F.array_contains("_again", _place()), F.lit(False))
    at = F.coalesce(F.array_position("_places", _place()), F.lit(0)).cast("int") - 1
    head, deprel = (
        F.when(repeated, _several_trees()).otherwise(F.get(c, at)) for c in ("_heads", "_deprels")
    )
    return rows.select(
        *keys,
        *[c for c in md.columns if c not in keys],
        int_or_null(head).alias("head"),
        deprel.alias("deprel"),
    )


def alignment_report(md: DataFrame, dep: DataFrame) -> DataFrame:
    """Row counts per sentence of two exploded tables and how far they match.

    ``status`` is ``ok``, ``length_differs`` (the first ``n_aligned`` rows are put
    together) or ``dep_missing`` (the sentence has no dependency rows at all). Tables of
    :func:`store_by_sentence` with as many buckets each are not shuffled.
    """
    keys = [k for k in key_columns(md) if k in dep.columns] + ["sentence_id"]
    n_md = md.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_md"))
    n_dep = dep.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_dep"))
    both = n_md.join(n_dep, keys, "left").withColumn(
        "n_dep", F.coalesce("n_dep", F.lit(0).cast("bigint"))
    )
    return _with_status(both, keys)


def response_alignment(decoded: DataFrame) -> DataFrame:
    """:func:`alignment_report` straight from decoded responses, without a shuffle."""
    keys = key_columns(decoded)
    pairs = _sentence_pairs(decoded).select(
        *keys,
        (F.col("_s") + 1).alias("sentence_id"),
        F.size(sentence_lines("_md")).cast("bigint").alias("n_md"),
        F.coalesce(F.array_size(sentence_lines("_dep")), F.lit(0)).cast("bigint").alias("n_dep"),
    )
    return _with_status(pairs, [*keys, "sentence_id"])


def _with_status(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    status = (
        F.when(F.col("n_dep") == 0, "dep_missing")
        .when(F.col("n_dep") != F.col("n_md"), "length_differs")
        .otherwise("ok")
    )
    return counts.select(
        *keys,
        "n_md",
        "n_dep",
        F.least("n_md", "n_dep").alias("n_aligned"),
        status.alias("status"),
    )


def with_token_id(
    df: DataFrame,
    order_col: str,
    rows_per_block: int = ROWS_PER_BLOCK,
    order_range: tuple[int, int] | None = None,
) -> DataFrame:
    """Number the rows 1..n inside each sentence of an existing table.

    ``order_col`` is an integer, a date or a timestamp that differs between the rows of a
    sentence; its values may lie as far apart as they like. The numbering is a prefix sum
    over a tree: rows lie in blocks of ``rows_per_block`` consecutive order values, as many
    consecutive blocks (at least 1024) in a block of the next level, and so on until one
    block holds the whole range of values. A block starts where the ones before it in its own larger block
    end, so no window holds more than twice as many rows, however long a sentence
    is and however sparse its order values are.

    Only sentences that do not fit in such a window need the tree. Unless ``order_range``
    is given, the table is read once when the plan is built and its rows are stored, packed by
    runs of neighbouring rows of a sentence (:func:`pack`), each put in order. Of sentences of up
    to twice ``rows_per_block`` rows, a run goes on numbering where the run before it ends, so
    that only runs are shuffled; where runs overlap, a window numbers the rows. The tree
    holds the rows of the other sentences, with as many levels as their smallest and largest
    order value ask for. With ``order_range``, all sentences go through a tree over that
    range. If the range fits in one block, each sentence is numbered by itself and nothing is
    joined. Rows with a NULL order value come first in their sentence; NULL keys are keys
    like others, so no row is lost.

    Decoded responses carry the number already and need none of this.
    """
    require_columns(df, "doc_id", "sentence_id", order_col)
    if rows_per_block < 1:
        raise ValueError("rows_per_block must be 1 or more")
    sentence = [*key_columns(df), "sentence_id"]
    order = _as_number(df, order_col)
    cols = [c for c in df.columns if c != "token_id"]
    rows = df.select("*", order.alias("_order"))

    def by_itself(some: DataFrame) -> DataFrame:
        whole = Window.partitionBy(*sentence).orderBy("_order")
        return some.withColumn("_rank", F.row_number().over(whole)).select(
            *cols, F.col("_rank").alias("token_id")
        )

    if order_range is None:
        if not can_pack(rows) or not isinstance(rows.schema["_order"].dataType, T.IntegralType):
            return _by_size(rows, sentence, order_col, rows_per_block, by_itself)
        # An order column that is a number already is packed once only.
        same = rows.schema[order_col].dataType == rows.schema["_order"].dataType
        twice = [order_col] if same and order_col not in sentence else []
        needless = [*twice, *({"token_id"} - {order_col})]
        packed = store(pack(rows.drop(*needless), sentence, "_order"), "zstd")
        fields = [f for f in rows.drop(*needless).schema if f.name not in sentence]

        def whole(some: DataFrame) -> DataFrame:
            return some.withColumns({c: F.col("_order") for c in twice})

        def by_runs(some: DataFrame) -> DataFrame:
            rows = whole(_by_runs(some, sentence, fields))
            return rows.select(*cols, F.col("_rank").alias("token_id"))

        odd = materialize(_odd_sentences(packed, sentence, rows_per_block))
        n_long, n_odd, *order_range = odd.agg(
            F.count_if("_long"), F.count(F.lit(1)), F.min(F.when(F.col("_long"), F.col("_low"))),
            F.max(F.when(F.col("_long"), F.col("_high"))),
        ).first()
        if not n_odd:
            return by_runs(packed)

        def chosen(how: str, listed: DataFrame) -> DataFrame:
            listed = listed.select("_sentence")
            listed = F.broadcast(listed) if n_odd <= _MOST_LONG else listed
            return packed.withColumn("_sentence", F.struct(*sentence)).join(listed, "_sentence", how).drop("_sentence")

        parts, even = [], chosen("left_anti", odd)
        if not even.isEmpty():
            parts.append(by_runs(even))
        if n_odd > n_long:
            mixed = chosen("left_semi", odd.where(~F.col("_long")))
            parts.append(by_itself(whole(unpack(mixed, fields, sentence))))
        if n_long:
            tall = whole(unpack(chosen("left_semi", odd.where("_long")), fields, sentence))
            tall = tall.select(*dict.fromkeys([*cols, order_col]))
            parts.append(with_token_id(tall, order_col, rows_per_block, tuple(order_range)))
        return reduce(DataFrame.unionByName, parts)
    least, most = (x or 0 for x in order_range)
    if most - least < rows_per_block:
        return by_itself(rows)

    # As one struct, which is never NULL itself, the keys may hold NULLs in a plain join,
    # and the join uses the shuffle and the sort of the numbering.
    def place(block):
        return F.struct(*[F.col(c) for c in sentence], block.alias("_block")).alias("_place")

    def within(column):
        return [F.col(column)[c].alias(c) for c in sentence]

    # Whole division keeps the order and, unlike a quotient, is exact for any bigint. It
    # cuts towards zero, so the block around zero has up to twice as many values.
    fan = max(_FAN, rows_per_block)
    levels = [
        rows.groupBy(place(F.expr(f"_order div {rows_per_block}"))).agg(F.count(F.lit(1)).alias("_n"))
    ]
    low, high = (int(Decimal(x) / rows_per_block) for x in (least, most))
    while high - low >= fan:
        above = levels[-1].select(*within("_place"), F.expr(f"_place._block div {fan}").alias("_block"), "_n")
        levels.append(above.groupBy(place(F.col("_block"))).agg(F.sum("_n").alias("_n")))
        low, high = (int(Decimal(x) / fan) for x in (low, high))

    def started(level: DataFrame, key: Column) -> DataFrame:
        """Where each block starts in the larger block ``key``."""
        before = (
            Window.partitionBy("_above")
            .orderBy(F.col("_place")["_block"])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return level.select("_place", "_n", key.alias("_above")).select(
            "_place", "_above", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
        )

    starts = started(levels[-1], F.struct(*within("_place"))).select("_place", "_start")
    for level in reversed(levels[:-1]):
        parent = F.expr(f"_place._block div {fan}").alias("_block")
        own = started(level, F.struct(*within("_place"), parent))
        of = starts.select(F.col("_place").alias("_above"), F.col("_start").alias("_base"))
        starts = own.join(of, "_above").select(
            "_place", (F.col("_base") + F.col("_start")).alias("_start")
        )
    inside = Window.partitionBy("_place").orderBy("_order")
    numbered = rows.select("*", place(F.expr(f"_order div {rows_per_block}"))).withColumn("_rank", F.row_number().over(inside))
    return numbered.join(starts, "_place").select(
        *cols, (F.col("_start") + F.col("_rank")).cast("int").alias("token_id")
    )


def _by_size(
    rows: DataFrame,
    sentence: Sequence[str],
    order_col: str,
    rows_per_block: int,
    by_itself: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Numbers rows that cannot be packed: long sentences by the tree, others by a window."""
    sizes = rows.groupBy(F.struct(*sentence).alias("_sentence")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_order").alias("_low"), F.max("_order").alias("_high")
    )
    long = materialize(sizes.where(F.col("_n") > 2 * rows_per_block))
    n, *order_range = long.agg(F.count(F.lit(1)), F.min("_low"), F.max("_high")).first()
    if not n:
        return by_itself(rows)
    listed = long.select("_sentence")
    listed = F.broadcast(listed) if n <= _MOST_LONG else listed
    tall, short = (
        rows.withColumn("_sentence", F.struct(*sentence)).join(listed, "_sentence", how).drop("_sentence")
        for how in ("left_semi", "left_anti")
    )
    tree = with_token_id(tall.drop("_order"), order_col, rows_per_block, tuple(order_range))
    return by_itself(short).unionByName(tree)


def _ends(packed: DataFrame) -> list[Column]:
    """The smallest and the largest order value of a run, NULL before all others."""
    first, last = F.get("_order", F.lit(0)), F.get("_order", F.col("_n") - 1)
    return [first.alias("_first"), last.alias("_last")]


def _odd_sentences(packed: DataFrame, sentence: Sequence[str], rows_per_block: int) -> DataFrame:
    """Sentences of too many rows for a window, ``_long``, and others with runs that overlap."""
    known = F.get(F.array_compact("_order"), F.lit(0)).alias("_low")
    runs = packed.select(F.struct(*sentence).alias("_sentence"), F.col("_n").cast("bigint"), *_ends(packed), known)
    before = F.max("_last").over(
        Window.partitionBy("_sentence").orderBy("_first", "_last").rowsBetween(Window.unboundedPreceding, -1)
    )
    # A run that begins with NULL belongs in front of every value.
    overlaps = before.isNotNull() & F.coalesce(F.col("_first") < before, F.lit(True))
    sizes = runs.withColumn("_overlaps", overlaps).groupBy("_sentence").agg(
        F.sum("_n").alias("_n"), F.max("_overlaps").alias("_overlaps"),
        F.min("_low").alias("_low"), F.max("_last").alias("_high"),
    )
    marked = sizes.withColumn("_long", F.col("_n") > 2 * rows_per_block)
    return marked.where("_long OR _overlaps").select("_sentence", "_long", "_low", "_high")


def _by_runs(packed: DataFrame, sentence: Sequence[str], fields: Sequence[T.StructField]) -> DataFrame:
    """``_rank`` of the rows of sentences whose runs do not overlap."""
    before = (
        Window.partitionBy(*sentence).orderBy("_first", "_last").rowsBetween(Window.unboundedPreceding, -1)
    )
    start = F.coalesce(F.sum("_n").over(before), F.lit(0)).cast("int")
    runs = packed.select("*", *_ends(packed)).withColumn("_start", start)
    rows = unpack(runs, fields, [*sentence, "_start"])
    return rows.withColumn("_rank", F.col("_start") + F.col("_place") + 1)


def _as_number(df: DataFrame, col: str) -> Column:
    """An order column as an integer: days of a date, microseconds of a timestamp."""
    kind = df.schema[col].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.col(col).cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(col)
    return _col(col)


def ambiguous_lattices(decoded: DataFrame) -> DataFrame:
    """``doc_id, ma_lattice``, undecoded, of the documents that have morphemes."""
    require_columns(decoded, "doc_id", "md_lattice", "ma_lattice")
    return decoded.where(F.rlike("md_lattice", F.lit(r"[^\n]"))).select(
        *key_columns(decoded), "ma_lattice"
    )
