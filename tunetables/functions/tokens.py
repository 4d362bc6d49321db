"""Token arrays: truncation, response spans, label masks, padding, termination.
All in-row array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: label of a position that takes no part in the loss.
IGNORED = -100


def _ids(values: list[int]) -> Column:
    return F.array(*[F.lit(int(v)) for v in values]).cast("array<int>")


def word_codes(text: Column) -> Column:
    """24-bit code per space-separated word, for token arrays without a tokeniser."""
    return F.transform(F.split(text, " ", -1), lambda w: F.conv(F.substring(F.md5(w), 1, 6), 16, 10).cast("int"))


def truncate_tokens(ids: Column, max_length: int, mode: str = "keep_start") -> Column:
    if mode == "keep_start":
        return F.slice(ids, 1, max_length)
    if mode == "keep_end":
        return F.slice(ids, F.greatest(F.size(ids) - max_length, F.lit(0)) + 1, F.lit(max_length))
    raise ValueError("mode must be keep_start or keep_end")


def find_pattern(ids: Column, pattern: list[int]) -> Column:
    """0-based starts of a sub-array, overlapping ones included. The first
    element is compared before any slice is cut."""
    if not pattern:
        raise ValueError("pattern must not be empty")
    n, want = len(pattern), _ids(pattern)
    places = F.sequence(F.lit(0), F.size(ids) - n)

    def hit(i: Column) -> Column:
        head = F.get(ids, i) == pattern[0]
        return head if n == 1 else F.when(head, F.slice(ids, i + 1, F.lit(n)) == want).otherwise(False)

    return F.when(F.size(ids) >= n, F.filter(places, hit)).otherwise(F.array().cast("array<int>"))


def response_spans(starts: Column, ends: Column, pattern_length: int) -> Column:
    """Half-open content spans. Each start takes the next unused end strictly
    after it; without one the span runs on (``to`` is null)."""
    begin = F.struct(
        F.lit(-1).alias("used"), F.array().cast("array<struct<from:int,to:int>>").alias("spans")
    )

    def step(acc: Column, s: Column) -> Column:
        end = F.array_min(F.filter(ends, lambda e: (e > s) & (e > acc["used"])))
        span = F.struct((s + pattern_length).alias("from"), end.alias("to"))
        return F.struct(
            F.coalesce(end, F.lit(2**31 - 1)).alias("used"),
            F.array_append(acc["spans"], span).alias("spans"),
        )

    return F.aggregate(starts, begin, step, lambda acc: acc["spans"])


def label_mask(ids: Column, spans: Column, attention: Column | None = None) -> Column:
    """Ids inside a span, IGNORED elsewhere and where attention is 0.

    Built from slices and fillers between them, so the cost is the length of
    the row, however many spans it has. Spans start and end in rising order but
    may overlap; the shared part belongs to the earlier one.
    """
    n = F.size(ids)

    def end(s: Column) -> Column:
        return F.greatest(s["from"], F.coalesce(s["to"], n))

    def piece(s: Column, i: Column) -> Column:
        done = F.when(i > 0, end(F.get(spans, i - 1))).otherwise(0)
        start = F.greatest(s["from"], done)
        filler = F.array_repeat(F.lit(IGNORED), start - done)
        return F.concat(filler, F.slice(ids, start + 1, F.greatest(end(s) - start, F.lit(0))))

    covered = F.when(F.size(spans) > 0, end(F.try_element_at(spans, F.lit(-1)))).otherwise(0)
    rest = F.array_repeat(F.lit(IGNORED), F.greatest(n - covered, F.lit(0)))
    labels = F.concat(F.flatten(F.transform(spans, piece)), rest)
    if attention is None:
        return labels
    return F.zip_with(labels, attention, lambda x, on: F.when(on != 0, x).otherwise(F.lit(IGNORED)))


def label_mask_report(
    ids: Column,
    labels: Column,
    starts: Column,
    ends: Column,
    spans: Column,
    max_length: int,
    attention: Column | None = None,
    min_labels: int = 1,
    report_truncated: bool = True,
) -> Column:
    """Audit of one row's labels as a struct, with the list of errors."""
    want = label_mask(ids, spans, attention)  # IGNORED where no label belongs
    seen = F.arrays_zip(ids.alias("id"), labels.alias("label"), want.alias("want"))

    def count(test) -> Column:
        return F.size(F.filter(seen, test))

    active = count(lambda z: z["label"] != IGNORED)
    leaks = count(lambda z: (z["label"] != IGNORED) & (z["want"] == IGNORED) & (z["id"] != IGNORED))
    wrong = count(lambda z: (z["want"] != IGNORED) & (z["label"] != z["id"]))
    if attention is None:
        padded, length = F.lit(0), F.size(ids)
    else:
        marked = F.arrays_zip(labels.alias("label"), attention.alias("on"))
        padded = F.size(F.filter(marked, lambda z: (z["label"] != IGNORED) & (z["on"] == 0)))
        length = F.aggregate(attention, F.lit(0), lambda a, x: a + x)
    no_end = ~F.exists(ends, lambda e: e > F.element_at(starts, -1))
    truncated = F.when(
        F.lit(report_truncated) & (F.size(starts) > 0), no_end & (length >= max_length)
    ).otherwise(False)
    # Wording of the audit errors.
    errors = F.filter(
        F.array(
            F.when(F.size(starts) == 0, "response_start_template was not found."),
            F.when(active < min_labels, f"assistant label token count is below {min_labels}."),
            F.when(leaks > 0, F.format_string("prompt label leak count=%d.", leaks)),
            F.when(padded > 0, F.format_string("padding label leak count=%d.", padded)),
            F.when(wrong > 0, F.format_string("target label mismatch count=%d.", wrong)),
        ),
        lambda e: e.isNotNull(),
    )
    return F.struct(
        active.alias("assistant_label_tokens"),
        F.size(starts).alias("response_start_count"),
        F.size(ends).alias("response_end_count"),
        leaks.alias("prompt_label_leaks"),
        padded.alias("padding_label_leaks"),
        wrong.alias("target_label_mismatches"),
        truncated.alias("truncated_assistant"),
        errors.alias("errors"),
    )


def require_clean(report: Column, value: Column) -> Column:
    """Strict mode: ``value`` when the report has no errors, else a failure."""
    message = F.concat(F.lit("label mask validation failed: "), F.array_join(report["errors"], "; "))
    return F.when(F.size(report["errors"]) == 0, value).otherwise(F.raise_error(message))


def pad_to(values: Column, length: Column | int, fill: int) -> Column:
    """Right padding; longer arrays stay as they are."""
    length = F.lit(length) if isinstance(length, int) else length
    gap = F.greatest(length - F.size(values), F.lit(0)).cast("int")
    return F.concat(values, F.array_repeat(F.lit(fill), gap))


def pad_fixed(values: Column, max_length: int, fill: int) -> Column:
    return pad_to(F.slice(values, 1, max_length), max_length, fill)


def round_up(length: Column, multiple: int | None) -> Column:
    if multiple is None:
        return length
    if multiple <= 0:
        raise ValueError("multiple must be positive")
    return (F.ceil(length / multiple) * multiple).cast("int")


def unpad(ids: Column, mask: Column) -> Column:
    return F.slice(ids, F.lit(1), F.aggregate(mask, F.lit(0), lambda a, x: a + x))


def is_terminated(
    ids: Column,
    terminal_ids: list[int],
    terminal_sequences: list[list[int]] = (),
    infer_short: bool = False,
    max_length: int | None = None,
) -> Column:
    last = F.try_element_at(ids, F.lit(-1))
    ended = last.isin(*[int(t) for t in terminal_ids]) if terminal_ids else F.lit(False)
    for seq in terminal_sequences:
        n = len(seq)
        tail = F.slice(ids, F.size(ids) - n + 1, F.lit(n)) if n else F.array().cast("array<int>")
        ended = ended | F.when(F.size(ids) >= n, tail == _ids(seq)).otherwise(False)
    out = F.when(F.size(ids) == 0, False).otherwise(ended)
    if infer_short:
        if max_length is None:
            raise ValueError("infer_short needs max_length")
        out = F.when(F.size(ids) < max_length, True).otherwise(out)
    return out


def mask_truncated(mask: Column, terminated: Column) -> Column:
    return F.when(terminated, mask).otherwise(F.transform(mask, lambda _: F.lit(0)))
