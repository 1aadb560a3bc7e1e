"""256-bit integers as decimal or hex text, inside code generation.

Spark's decimals stop at 38 digits, so a number is held as twelve limbs of 7 digits in plain 64-bit integers. A limb
leaves room for the sum of 900 billion rows of one group; limbs are summed as they are, signed where something is
taken away, and carried once at the end. A group of any size costs twelve integers per task.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.text import col

LIMBS, DIGITS = 12, 7
_BASE = 10**DIGITS


def padded(text: Column | str) -> Column:
    """Decimal text at full width; null where the text is no unsigned integer of at most 84 digits."""
    t = F.btrim(col(text))
    return F.lpad(F.when(t.rlike(rf"^\d{{1,{LIMBS * DIGITS}}}$"), t), LIMBS * DIGITS, "0")


def limbs_of(wide: Column) -> list[Column]:
    """Limbs of a padded text from the lowest to the highest."""
    return [F.substring(wide, (LIMBS - 1 - i) * DIGITS + 1, DIGITS).cast("bigint") for i in range(LIMBS)]


def limbs(text: Column | str) -> list[Column]:
    """Limbs of decimal text from the lowest to the highest."""
    return limbs_of(padded(text))


def carried(parts: Column) -> Column:
    """digits: the limbs brought below their base, lowest first; carry: what is left above the highest, negative
    where the number is."""
    zero = F.struct(F.lit(0).cast("bigint").alias("carry"), F.array().cast("array<bigint>").alias("digits"))

    def step(acc: Column, part: Column) -> Column:
        total = part + acc["carry"]
        digit = F.pmod(total, F.lit(_BASE).cast("bigint"))
        return F.struct(F.call_function("div", total - digit, F.lit(_BASE).cast("bigint")).alias("carry"), F.concat(acc["digits"], F.array(digit)).alias("digits"))

    return F.aggregate(parts, zero, step)


def render(parts: list[Column]) -> Column:
    """Decimal text of limbs of any size and sign, without leading zeros; null if any limb is null."""
    whole = F.array(*parts)

    def text(sized: Column) -> Column:
        padded_digits = F.transform(F.reverse(sized["digits"]), lambda d: F.lpad(d.cast("string"), DIGITS, "0"))
        return F.regexp_replace(F.concat(sized["carry"].cast("string"), F.array_join(padded_digits, "")), r"^0+(?=\d)", "")

    def signed(sized: Column) -> Column:
        below = F.transform(whole, lambda x: -x)
        return F.when(sized["carry"] < 0, F.concat(F.lit("-"), F.transform(F.array(carried(below)), text)[0])).otherwise(text(sized))

    known = ~F.exists(whole, lambda x: x.isNull())
    return F.when(known, F.transform(F.array(carried(whole)), signed)[0])


def sum_text(text: Column | str) -> Column:
    """Aggregate: the exact sum of decimal texts, as text; nulls and texts that are no integers are skipped."""
    return sum_padded(padded(text))


def sum_padded(wide: Column, sign: Column | None = None) -> Column:
    """The same for a column of :func:`padded` texts, which is best computed once in a step of its own; with ``sign``
    (1 or -1 per row) the rows are added or taken away."""
    return render([F.sum(p if sign is None else p * sign) for p in limbs_of(wide)])


def greater(a: Column, b: Column) -> Column:
    """Whether one decimal text is greater than another."""
    return padded(a) > padded(b)


def minus_text(a: Column, b: Column) -> Column:
    """Signed difference of two decimal texts, with a leading minus where it is negative."""
    return render([x - y for x, y in zip(limbs(a), limbs(b), strict=True)])


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row, however often ``use`` names it."""
    return F.transform(F.array(value), use)[0]


def from_bytes(data: Column, start: int, length: int = 32, signed: bool = False) -> Column:
    """Decimal text of a big-endian integer of up to 32 bytes at a 1-based place of a binary value.

    What fits in 64 bits is read as one machine word. Any other is extended to 256 bits by its sign and is a sum of
    32-bit words times powers of 2; the powers are constants split into limbs, so every limb is one linear form below 63
    bits and a single carry follows, words and limbs being computed once each. ``signed`` reads two's complement of that
    length. Null where the value is shorter than asked.
    """
    part = F.substring(data, start, length)
    fill = F.when(F.substring(part, 1, 1) >= F.lit(b"\x80"), "F").otherwise("0") if signed else F.lit("0")
    if length > 8:  # bytes are cut and compared before anything becomes text
        low, above = F.substring(part, length - 7, 8), F.substring(part, 1, length - 8)
        zeros, ones, half = F.lit(bytes(length - 8)), F.lit(b"\xff" * (length - 8)), F.lit(b"\x80" + bytes(7))
        short = (above == zeros) & (low < half) | (above == ones) & (low >= half) if signed else above == zeros
        word = F.hex(low)
    else:
        short, word = F.lit(True), F.lpad(F.hex(part), 16, fill)
    digits = F.lpad(F.hex(part), 64, fill)
    words = F.array(*[F.conv(F.substring(digits, 64 - 8 * i - 7, 8), 16, 10).cast("bigint") for i in range(8)])

    def limbs_of_words(w: Column) -> Column:
        sums = []
        for j in range(LIMBS):
            limb = lambda n, j=j: n // _BASE**j % _BASE
            total = F.lit(0).cast("bigint")
            for i in range(8):
                if f := limb(2 ** (32 * i)):
                    total = total + w[i] * F.lit(f).cast("bigint")
            sums.append(total - F.when(w[7] >= 2**31, limb(2**256)).otherwise(0).cast("bigint") if signed else total)
        return F.array(*sums)

    wide = _once(words, lambda w: _once(limbs_of_words(w), lambda s: render([s[j] for j in range(LIMBS)])))
    text = F.when(short, F.conv(word, 16, -10 if signed else 10)).otherwise(wide)
    return F.when(F.length(part) == length, text)


def as_double(text: Column, decimals: Column | int = 0) -> Column:
    """A rounded view for display: the number divided by ten to the decimals."""
    scale = F.lit(decimals) if isinstance(decimals, int) else decimals
    return text.try_cast("double") / F.pow(F.lit(10.0), scale)
