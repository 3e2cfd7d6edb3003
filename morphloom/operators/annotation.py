"""Run an annotator over documents and decode what it returns."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import or_

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from morphloom.functions import to_wire
from morphloom.operators.calls import Calls, DirectCalls
from morphloom.schemas import RESPONSE_FIELDS, key_columns, require_columns

Annotator = Callable[[str], "str | None"]

# Responses are many times as long as their texts: hand them to the JVM in pieces.
_FLUSH_BYTES = 8_000_000


def _policy(on_error: str) -> bool:
    if on_error not in ("fail", "keep"):
        raise ValueError(f"on_error must be 'fail' or 'keep', not {on_error!r}")
    return on_error == "keep"


def wire_text(docs: DataFrame, pre_tokenized: bool = False) -> DataFrame:
    """Documents with their ``wire`` text; pre-tokenised text is taken verbatim."""
    require_columns(docs, "doc_id", "text")
    wire = F.col("text") if pre_tokenized else to_wire("text")
    return docs.select(*key_columns(docs), wire.alias("wire"))


def annotate(
    docs: DataFrame,
    annotator_factory: Callable[[], Annotator],
    pre_tokenized: bool = False,
    on_error: str = "fail",
    partitions: int | None = None,
    in_flight: int = 1,
    deadline: float | None = None,
) -> DataFrame:
    """Call an annotator on every document: ``doc_id, response``.

    ``annotator_factory`` is called once per partition and returns a function from
    wire text to response JSON, so that a model or connection is set up once and
    used for many documents. Tasks may be repeated after a loss, so the annotator
    must be safe to call twice on one text. A NULL text is not sent.

    ``on_error='fail'`` stops the job at the first failing document; ``'keep'``
    gives that document a NULL response and its message in ``error``.
    ``partitions`` deals the documents out first, for inputs with too few splits.

    An annotator that waits for a service can have up to ``in_flight`` calls at once in
    each task; the answers keep the order of the documents. ``deadline`` is the time in
    seconds that a call may take; one without an answer by then is a failing document.
    With either of them the calls come from threads, and the factory is called once per
    thread, again for a thread that replaces one whose call hangs.

    The result is lazy: each action on it calls the annotator again. Write it, or
    use :func:`morphloom.materialize`, before reading it more than once.
    """
    keep = _policy(on_error)
    if in_flight < 1 or (deadline is not None and deadline <= 0):
        raise ValueError("in_flight must be 1 or more and deadline above 0")
    wired = wire_text(docs, pre_tokenized)
    if partitions:
        wired = wired.repartition(partitions)
    keys = key_columns(wired)
    fields = [wired.schema[k] for k in keys] + [T.StructField("response", T.StringType())]
    if keep:
        fields.append(T.StructField("error", T.StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if in_flight == 1 and deadline is None:
            calls = DirectCalls(annotator_factory)
        else:
            calls = Calls(annotator_factory, in_flight, deadline)
        # Calls go on from one batch to the next, so that one that hangs at the end of a batch
        # does not hold up those behind it.
        opened: deque[pa.RecordBatch] = deque()

        def wires() -> Iterator[str | None]:
            for batch in batches:
                if batch.num_rows:
                    opened.append(batch)
                yield from (wire.as_py() for wire in batch.column(len(keys)))

        i, start, held, out, errors = 0, 0, 0, [], []
        for response, failure in calls.answers(wires()):
            batch, error = opened[0], None
            try:
                if failure is not None:
                    raise failure
                if response is not None and not isinstance(response, str):
                    raise TypeError(f"answer of type {type(response).__name__}")
                # An unpaired surrogate is no text.
                body = None if response is None else response.encode()
            except Exception as exc:
                if not keep:
                    doc = batch.column(0)[i].as_py()
                    raise RuntimeError(f"annotator failed on document {doc!r}") from exc
                body, error = None, f"{type(exc).__name__}: {exc}"
            out.append(body)
            errors.append(error)
            held += len(body or b"")
            i += 1
            if held >= _FLUSH_BYTES or i == batch.num_rows:
                cols = [batch.column(k).slice(start, i - start) for k in range(len(keys))]
                cols.append(pa.array(out, pa.binary()).view(pa.string()))
                if keep:
                    cols.append(pa.array(errors, pa.string()))
                yield pa.RecordBatch.from_arrays(cols, names=[f.name for f in fields])
                start, held, out, errors = i, 0, [], []
            if i == batch.num_rows:
                opened.popleft()
                i = start = 0
        calls.close()

    return wired.mapInArrow(run, T.StructType(fields))


def _may_be_json(value: Column) -> Column:
    """Whether a field's text can stem from a number, flag, object or array. The parser
    writes those without tabs or line breaks, so a lattice is passed at its first tab."""
    plain = ~F.contains(value, F.lit("\t")) & ~F.contains(value, F.lit("\n"))
    return F.coalesce(plain & F.substring(value, 1, 1).rlike(r"[\[{\-0-9tf]"), F.lit(False))


def decode_responses(
    df: DataFrame,
    on_error: str = "fail",
    fields: Sequence[str] = RESPONSE_FIELDS,
) -> DataFrame:
    """Response JSON to one string column per field; NULL where a field is absent.

    Only the named ``fields`` are taken out of the JSON; the parser skips the rest.
    An empty object, an empty body and ``[]`` or ``null`` are answers without
    content. Any other text that is no JSON object, and an object in which one of
    ``fields`` is neither a string nor null, is malformed: the job fails, or
    with ``'keep'`` the row gets NULL fields and a message in ``error``. An ``error``
    that is already there, from :func:`annotate`, counts like a malformed answer.
    """
    keep = _policy(on_error)
    require_columns(df, "doc_id", "response")
    unknown = [f for f in fields if f not in RESPONSE_FIELDS]
    if unknown:
        raise ValueError(f"unknown response field(s) {unknown}")
    schema = T.ArrayType(T.StructType([T.StructField(f, T.StringType()) for f in fields]))
    keys = key_columns(df)
    had_error = "error" in df.columns

    # As the only element of an array, so that text or a second value behind the object
    # breaks the whole: one parse tells both what is in the body and that nothing else is.
    whole = F.concat(F.lit("["), F.col("response"), F.lit("]"))
    parsed = df.select(
        *keys,
        F.from_json(whole, schema).alias("_values"),
        F.col("response").alias("_body"),
        *([F.col("error")] if had_error else []),
    ).select("*", F.get("_values", F.lit(0)).alias("_json"))
    one = F.coalesce(F.size("_values") == 1, F.lit(False)) & F.col("_json").isNotNull()
    # No object: an empty body, an empty array or null is an answer without content. Whatever
    # reads the whole body stands behind a condition that hardly any body meets.
    plain = F.startswith("_body", F.lit("{"))
    bare = F.rlike("_body", F.lit(r"\A(?:[ \t\r\n]*+(?:\[\]|null)[ \t\r\n]*+)?+\z"))
    empty = F.when(plain, False).otherwise(F.coalesce(bare, F.lit(True)))
    # An array in the place of the object is read as one whose fields are all absent.
    absent = ~F.coalesce(reduce(or_, [F.col("_json")[f].isNotNull() for f in fields]), F.lit(False))
    opened = F.rlike("_body", F.lit(r"\A[ \t\r\n]*+\{"))
    no_object = F.when(plain | ~absent, False).otherwise(~opened)
    no_text = reduce(or_, [_may_be_json(F.col("_json")[f]) for f in fields])
    named = rf'"(?:{"|".join(fields)})"\s*+:\s*+(?!"|null)'
    no_text = F.when(no_text, F.rlike("_body", F.lit(named))).otherwise(False)
    bad = ~empty & (~one | F.coalesce(no_object, F.lit(False)) | F.coalesce(no_text, F.lit(False)))
    message = F.concat(
        F.lit("malformed response of document "),
        F.coalesce("doc_id", F.lit("NULL")),
    )
    if keep:
        values = [F.when(~bad, F.col("_json")[f]).alias(f) for f in fields]
        error = F.when(bad, message)
        if had_error:
            error = F.coalesce(F.col("error"), error)
        return parsed.select(*keys, *values, error.alias("error"))
    if had_error:
        message = F.coalesce("error", message)
        bad = bad | F.col("error").isNotNull()
    values = [
        F.when(bad, F.raise_error(message).cast("string")).otherwise(F.col("_json")[f]).alias(f)
        for f in fields
    ]
    return parsed.select(*keys, *values)
