"""Per-row decoding of flow message fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telescry.functions.text import truthy


def underscore_list(c: Column) -> Column:
    return F.when(truthy(c), F.split(c, "_", -1))


def as_numbers(as_path: Column) -> Column:
    """``a_b_c`` -> whole numbers; other tokens are skipped; null for missing text."""
    return F.filter(F.transform(underscore_list(as_path), lambda p: p.try_cast("bigint")), lambda n: n.isNotNull())


def run_starts(numbers: Column) -> Column:
    """Positions at which a run of equal neighbours begins."""
    positions = F.when(F.size(numbers) > 0, F.sequence(F.lit(0), F.size(numbers) - 1)).when(
        numbers.isNotNull(), F.array().cast("array<int>"))
    return F.filter(positions, lambda i: (i == 0) | (F.get(numbers, i) != F.get(numbers, i - 1)))


def path_without_repeats(numbers: Column, starts: Column) -> Column:
    return F.transform(starts, lambda i: F.get(numbers, i))


def path_padding(numbers: Column, starts: Column, mode: str = "reference") -> Column:
    """Repeat counts of the path.

    ``reference`` shifts them by one (the count of a run stands on the next number, the first is 1);
    ``true_run_length`` puts every run's length on its own number.
    """
    if mode == "reference":
        return F.transform(starts, lambda s, k: F.when(k == 0, 1).otherwise(s - F.get(starts, k - 1)))
    if mode == "true_run_length":
        return F.transform(starts, lambda s, k: F.coalesce(F.get(starts, k + 1), F.size(numbers)) - s)
    raise ValueError(f"Unknown AS path mode: {mode}")


def label_tokens(separate: list[Column], joined: Column) -> Column:
    """Labels from the numbered fields up to the first gap, else from the joined text; null if none."""
    listed = F.array(*[F.coalesce(c, F.lit("")) for c in separate])
    gap = F.array_position(listed, "")
    head = F.slice(listed, F.lit(1), F.when(gap == 0, F.lit(len(separate))).otherwise(gap.cast("int") - 1))
    return F.when(F.size(head) > 0, head).otherwise(underscore_list(joined))


def label_words(tokens: Column) -> Column:
    """Hex words such as ``01-2a-bc`` as unsigned 64-bit numbers; what is no hex number is skipped, what is larger becomes null."""
    plain = F.transform(tokens, lambda t: F.replace(t, F.lit("-"), F.lit("")))
    good = F.filter(plain, lambda t: t.rlike("^[0-9A-Fa-f]+$"))
    short = F.transform(good, lambda t: F.regexp_replace(t, "^0+(?=.)", ""))
    return F.transform(short, lambda t: F.when(F.length(t) <= 16, F.conv(t, 16, -10).cast("bigint")))


def label_values(words: Column) -> Column:
    return F.transform(words, lambda w: F.shiftrightunsigned(w, 4))


def label_exp(words: Column) -> Column:
    return F.transform(words, lambda w: F.shiftright(w.bitwiseAND(14), 1))


def bottom_label(labels: Column) -> Column:
    """Last label that is not zero."""
    return F.get(F.reverse(F.filter(labels, lambda v: v != 0)), F.lit(0))


def until_first_gap(items: list[Column]) -> Column:
    """Whole numbers of a numbered field family up to the first missing or bad one; what follows it is not read."""
    gap = F.lit(len(items))
    for at, item in reversed(list(enumerate(items))):
        gap = F.when(item.try_cast("bigint").isNull(), F.lit(at)).otherwise(gap)
    return F.transform(F.slice(F.array(*items), F.lit(1), gap), lambda c: c.try_cast("bigint"))
