"""Masking of sensitive patterns in free text.

The patterns are ours and openly stated. Identifiers with check digits count only
where these are right, so that other runs of digits stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from usagelens.functions import checks
from usagelens.functions.binding import let

# Edges of an ASCII word. Java's own word boundary also counts accented letters,
# which would hide a number that follows one.
_START, _END = "(?<![0-9A-Za-z_])", "(?![0-9A-Za-z_])"

_DOMAIN = f"[A-Za-z0-9-][A-Za-z0-9.-]*[.][A-Za-z]{{2,}}{_END}"

# Applied in this order: long, specific shapes first, so that a shorter pattern
# cannot eat part of a longer one. Every pattern is linear in the text: starts
# are anchored, and repeats are possessive, bounded or of one fixed length.
PATTERNS = {
    "PRIVATE_KEY": "-----BEGIN [A-Z ]*PRIVATE KEY( BLOCK)?-----(?s:.*?)(-----END [A-Z ]*PRIVATE KEY( BLOCK)?-----|\\z)",
    "ACCESS_KEY": f"{_START}(AKIA|ASIA)[0-9A-Z]{{16}}{_END}",
    "SECRET_KEY": f"{_START}(?i:aws_secret_access_key|secret_key|api_key)[\"']? *[=:] *[\"']?[A-Za-z0-9/+=_-]{{16,}}",
    # What may be an address, up to the end of its domain's signs; _address finds its end.
    "EMAIL": f"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?={_DOMAIN})[A-Za-z0-9.-]++_?",
    "IBAN": f"{_START}[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{2,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}",
    "VEHICLE": f"{_START}[A-HJ-NPR-Z0-9]{{17}}{_END}",
    "CNPJ_BR": f"{_START}[0-9]{{2}}[.]?[0-9]{{3}}[.]?[0-9]{{3}}/?[0-9]{{4}}-?[0-9]{{2}}{_END}",
    "INSEE_FR": f"{_START}[12] ?[0-9]{{2}} ?[0-9]{{2}} ?(?:[0-9]{{2}}|2[AB]) ?[0-9]{{3}} ?[0-9]{{3}} ?[0-9]{{2}}{_END}",
    "CARD": f"{_START}(?:[0-9]{{4}}[ -]?[0-9]{{4}}[ -]?[0-9]{{4}}[ -]?[0-9]{{4}}(?:[ -]?[0-9]{{1,3}})?|[0-9]{{4}}[ -]?[0-9]{{6}}[ -]?[0-9]{{4,5}}|[0-9]{{13,19}}){_END}",
    "CPF_BR": f"{_START}[0-9]{{3}}[.]?[0-9]{{3}}[.]?[0-9]{{3}}-?[0-9]{{2}}{_END}",
    "TAXID_DE": f"{_START}[0-9]{{2}} ?[0-9]{{3}} ?[0-9]{{3}} ?[0-9]{{3}}{_END}",
    "NHS_GB": f"{_START}[0-9]{{3}} ?[0-9]{{3}} ?[0-9]{{4}}{_END}",
    "PROVIDER_US": f"{_START}[12][0-9]{{9}}{_END}",
    "ROUTING_US": f"{_START}[0-9]{{9}}{_END}",
    "DEA_US": f"{_START}[ABFGMPRX][A-Z9][0-9]{{7}}{_END}",
    "NIF_ES": f"{_START}[0-9]{{8}}[ -]?[A-Z]{_END}",
    "NIE_ES": f"{_START}[XYZ][ -]?[0-9]{{7}}[ -]?[A-Z]{_END}",
    "SSN_US": f"{_START}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{_END}",
    "PHONE_US": f"([+]1[ .-]?)?([(][0-9]{{3}}[)] ?|{_START}[0-9]{{3}}[ .-])[0-9]{{3}}[ .-][0-9]{{4}}{_END}",
    "IPV4": f"{_START}[0-9]{{1,3}}[.][0-9]{{1,3}}[.][0-9]{{1,3}}[.][0-9]{{1,3}}{_END}",
}
CHECKS = {
    "IBAN": checks.iban,
    "VEHICLE": checks.vehicle,
    "CNPJ_BR": checks.cnpj,
    "INSEE_FR": checks.french,
    "CARD": checks.luhn,
    "CPF_BR": checks.cpf,
    "TAXID_DE": checks.german_tax,
    "NHS_GB": checks.nhs,
    "PROVIDER_US": checks.provider,
    "ROUTING_US": checks.routing,
    "DEA_US": checks.dea,
    "NIF_ES": checks.spanish,
    "NIE_ES": checks.spanish,
}
# What a text must hold for a pattern to match at all. Looking for that is much
# cheaper than the pattern, and most texts hold none of it.
_FRAGMENTS = {
    "PRIVATE_KEY": ["PRIVATE KEY"],
    "ACCESS_KEY": ["AKIA", "ASIA"],
    "EMAIL": ["@"],
}
_SHAPES = {"SECRET_KEY": "(?i)_key", "IBAN": "[A-Z]{2}[0-9]{2}", "VEHICLE": "[A-HJ-NPR-Z0-9]{17}"}
_DIGITS = "[0-9][ .-]?[0-9][ .-]?[0-9]"


def _needs(name: str) -> list[str] | str:
    """Fragments, or else a shape, one of which a text must hold."""
    return _FRAGMENTS.get(name) or _SHAPES.get(name, _DIGITS)


def _may_match(text: Column, name: str) -> Column:
    needs = _needs(name)
    return text.rlike(needs) if isinstance(needs, str) else reduce(Column.__or__, [text.contains(f) for f in needs])


def _address(found: Column) -> Column:
    """The address at the head of a match of EMAIL, '' if there is none: labels are not empty, the last is letters."""
    return F.regexp_extract(F.split_part(found, F.lit(".."), F.lit(1)), f"^[^@]+@{_DOMAIN}", 0)


def _matches(text: Column, name: str) -> Column:
    return F.regexp_extract_all(text, F.lit(PATTERNS[name]), F.lit(0))


def _replacing(name: str) -> Callable[[Column], Column]:
    """A function that replaces each match which passes its check."""
    label = F.lit(f"[{name}]")

    def one(found: Column) -> Column:
        if name == "EMAIL":
            return let(_address(found), lambda x: F.when(x != "", F.concat(label, F.substring(found, F.length(x) + 1, F.length(found)))).otherwise(found))
        return F.when(CHECKS[name](found), label).otherwise(found)

    def replaced(text: Column) -> Column:
        between = F.split(text, PATTERNS[name], -1)  # one more than there are matches
        pieces = F.zip_with(between, _matches(text, name), lambda x, found: F.concat(x, F.when(found.isNull(), "").otherwise(one(found))))
        return F.when(text.rlike(PATTERNS[name]), F.array_join(pieces, "")).otherwise(text)

    return replaced


def _in_turn(text: Column, steps: Sequence[Callable[[Column], Column]]) -> Column:
    """The steps applied one after another: a fold, since nested expressions would grow with their number."""

    def step(so_far: Column, i: Column) -> Column:
        chosen = F.when(i == 0, steps[0](so_far))
        for k, do in enumerate(steps[1:], 1):
            chosen = chosen.when(i == k, do(so_far))
        return chosen

    return F.aggregate(F.array(*map(F.lit, range(len(steps)))), text, step) if steps else text


def mask(text: Column, names: Sequence[str] | None = None) -> Column:
    """Replace each match by ``[NAME]``; the whole text is searched."""

    def plain(name: str) -> Callable[[Column], Column]:
        return lambda found: F.regexp_replace(found, PATTERNS[name], f"[{name}]")

    def guarded(group: list[str]) -> Callable[[Column], Column]:
        steps = [_replacing(n) if n == "EMAIL" or n in CHECKS else plain(n) for n in group]
        return lambda found: F.when(_may_match(found, group[0]), _in_turn(found, steps)).otherwise(found)

    # Neighbours that need the same thing are guarded together.
    return _in_turn(text, [guarded(list(group)) for _, group in groupby(PATTERNS if names is None else names, _needs)])


def hits(text: Column, name: str) -> Column:
    """How often a pattern, with its check, occurs in the text as it stands."""
    if name == "EMAIL":
        found = F.size(F.filter(_matches(text, name), lambda x: _address(x) != "")).cast("long")
    elif name in CHECKS:
        found = F.size(F.filter(_matches(text, name), CHECKS[name])).cast("long")
    else:
        found = F.regexp_count(text, F.lit(PATTERNS[name])).cast("long")
    return F.when(_may_match(text, name), found).when(text.isNotNull(), 0)
