"""Check digits of public identifiers, as column expressions.

Each function takes a matched text and returns whether its check digit, or check
letters, are right. Signs between digits do not count.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens.functions.binding import let

# --- fixed values: weights, letters and ranges of the published schemes -------------
ROUTING_WEIGHTS = (3, 7, 1, 3, 7, 1, 3, 7, 1)
ROUTING_RANGES = ((0, 12), (21, 32), (61, 72), (80, 80))
CPF_WEIGHTS = (11, 10, 9, 8, 7, 6, 5, 4, 3, 2)
CNPJ_WEIGHTS = (6, 5, 4, 3, 2, 9, 8, 7, 6, 5, 4, 3, 2)
NHS_WEIGHTS = (10, 9, 8, 7, 6, 5, 4, 3, 2)
DEA_WEIGHTS = (1, 2, 1, 2, 1, 2)
PROVIDER_PREFIX = "80840"
VEHICLE_WEIGHTS = (8, 7, 6, 5, 4, 3, 2, 10, 0, 9, 8, 7, 6, 5, 4, 3, 2)
VEHICLE_LETTERS = "ABCDEFGHJKLMNPRSTUVWXYZ"
VEHICLE_VALUES = "12345678123457923456789"
SPANISH_LETTERS = "TRWAGMYFPDXBNJZSQVHLCKE"
# --- end of fixed values --------------------------------------------------------------


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def numbers(digits: Column) -> Column:
    """The digits of a text of digits, as an array."""
    return F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(digits, i, F.lit(1)).cast("int"))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def weighted(values: Column, weights: Sequence[int]) -> Column:
    """Sum of the first values times their weights."""
    return total(F.zip_with(F.slice(values, 1, len(weights)), F.array(*map(F.lit, weights)), lambda x, w: x * w))


def of_digits(check: Callable[[Column], Column]) -> Callable[[Column], Column]:
    """A check of the array of a text's digits, which is made once."""
    return lambda text: let(numbers(digits_of(text)), check)


def _luhn(values: Column) -> Column:
    doubled = F.transform(F.reverse(values), lambda x, i: F.when(i % 2 == 0, x).otherwise((2 * x) % 10 + F.floor(x / 5).cast("int")))
    return total(doubled) % 10 == 0


luhn = of_digits(lambda v: _luhn(v) & (total(v) > 0))


def provider(text: Column) -> Column:
    return luhn(F.concat(F.lit(PROVIDER_PREFIX), digits_of(text)))


@of_digits
def routing(v: Column) -> Column:
    start = 10 * v[0] + v[1]
    inside = F.lit(False)
    for low, high in ROUTING_RANGES:
        inside |= start.between(low, high)
    return inside & (weighted(v, ROUTING_WEIGHTS) % 10 == 0) & (total(v) > 0)


def _eleven(v: Column, weights: Sequence[int]) -> Column:
    """The check digit that a weighted sum modulo 11 gives: eleven less the rest, 0 for a rest below two."""
    rest = weighted(v, weights) % 11
    return F.when(rest < 2, 0).otherwise(11 - rest)


@of_digits
def cpf(v: Column) -> Column:
    varied = F.size(F.array_distinct(v)) > 1
    return varied & (v[9] == _eleven(v, CPF_WEIGHTS[1:])) & (v[10] == _eleven(v, CPF_WEIGHTS))


@of_digits
def cnpj(v: Column) -> Column:
    return (total(v) > 0) & (v[12] == _eleven(v, CNPJ_WEIGHTS[1:])) & (v[13] == _eleven(v, CNPJ_WEIGHTS))


@of_digits
def nhs(v: Column) -> Column:
    return (total(v) > 0) & ((11 - weighted(v, NHS_WEIGHTS) % 11) % 11 == v[9])


@of_digits
def german_tax(v: Column) -> Column:
    """ISO 7064, modulo 11 and 10."""
    step = lambda p, x: (2 * F.when((x + p) % 10 == 0, 10).otherwise((x + p) % 10)) % 11
    product = F.aggregate(F.slice(v, 1, 10), F.lit(10), step)
    return (v[0] > 0) & ((11 - product) % 10 == v[10])


def dea(text: Column) -> Column:
    return let(numbers(F.right(text, F.lit(7))), lambda v: weighted(v, DEA_WEIGHTS) % 10 == v[6])


def vehicle(text: Column) -> Column:
    values = numbers(F.translate(text, VEHICLE_LETTERS, VEHICLE_VALUES))
    given = F.substring(text, 9, 1)
    rest = let(values, lambda v: weighted(v, VEHICLE_WEIGHTS) % 11)
    varied = let(values, lambda v: F.size(F.array_distinct(v)) > 1)
    return varied & (F.when(rest == 10, "X").otherwise(rest.cast("string")) == given)


def spanish(text: Column) -> Column:
    """Eight digits, or X, Y or Z for the first, and the letter of their number modulo 23."""
    plain = F.regexp_replace(text, "[ -]", "")
    number = F.translate(F.left(plain, F.lit(8)), "XYZ", "012").cast("int")
    return F.substring(F.lit(SPANISH_LETTERS), number % 23 + 1, F.lit(1)) == F.right(plain, F.lit(1))


def french(text: Column) -> Column:
    """Thirteen signs, where 2A and 2B stand for 19 and 18, and 97 less their rest modulo 97."""
    plain = F.regexp_replace(text, " ", "")
    number = F.replace(F.replace(F.left(plain, F.lit(13)), F.lit("2A"), F.lit("19")), F.lit("2B"), F.lit("18")).cast("long")
    return 97 - number % 97 == F.right(plain, F.lit(2)).cast("int")


def iban(text: Column) -> Column:
    """Modulo 97 with the first four signs moved to the end, letters counting from ten on."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.left(plain, F.lit(4)))
    signs = F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: F.ascii(F.substring(turned, i, F.lit(1))))
    step = lambda a, c: F.when(c < 58, a * 10 + c - 48).otherwise(a * 100 + c - 55) % 97
    return F.length(plain).between(15, 34) & (F.aggregate(signs, F.lit(0), step) == 1)
