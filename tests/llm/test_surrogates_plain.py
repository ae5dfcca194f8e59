"""Surrogates in texts that are put together from known parts: what is an entity, and what isn't, is known beforehand."""

from __future__ import annotations

import random
import re

from usagelens.llm import surrogates

# Entities by kind, several spellings of one in a group.
ENTITIES = {
    "email": [["ann.lee@mail.example.com", "ANN.LEE@MAIL.EXAMPLE.COM"], ["b_2@x.org"], ["c+d@sub.domain.net"]],
    "card": [["4532015112830366", "4532 0151 1283 0366", "4532-0151-1283-0366"], ["378282246310005"]],
    "ip": [["10.1.2.30"], ["8.8.4.4"], ["192.168.100.7"]],
    "ssn": [["123-45-6789"], ["219-09-9999"]],
    "iban": [["DE89370400440532013000", "DE89 3704 0044 0532 0130 00"], ["GB82WEST12345698765432"]],
    "phone": [["+1 (213) 555-1234", "+1 213 555 1234", "213-555-1234"], ["+49 171 5551234"]],
}
PLAIN = ["see the note ", ", then ", " and ", "; 12 of 345 items, ", " at 3.50 euros; ", " on page 2024. ", " (version two) ", "\nnext line: ", " — über "]
# A mark of no kind, so that entities never touch what is between them.
SHAPES = {"email": r"[^ ,;()\n]+", "card": r"[\d -]+", "ip": r"[\d.]+", "ssn": r"[\d-]+", "iban": r"[A-Z\d ]+", "phone": r"[\d+() -]+"}


def texts(r):
    """(text, its parts): a part is plain, or an entity's kind, number and spelling."""
    for _ in range(120):
        parts = [r.choice(PLAIN)]
        for _ in range(r.randint(0, 7)):
            kind = r.choice(sorted(ENTITIES))
            number = r.randrange(len(ENTITIES[kind]))
            parts += [(kind, number, r.choice(ENTITIES[kind][number])), r.choice(PLAIN)]
        yield "".join(p if isinstance(p, str) else f"<{p[2]}>" for p in parts), parts


def test_known_parts_are_replaced_and_nothing_else(spark):
    given = list(texts(random.Random(4)))
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(given)], "doc_id long, text string")
    got = {x.doc_id: x for x in surrogates.replace(docs).collect()}
    book: dict[tuple, str] = {}
    for i, (_, parts) in enumerate(given):
        pattern = "".join(re.escape(p) if isinstance(p, str) else f"<({SHAPES[p[0]]})>" for p in parts)
        found = re.fullmatch(pattern, got[i].text)
        assert found, (got[i].text, pattern)
        entities = [p for p in parts if not isinstance(p, str)]
        assert got[i].n_entities == len(entities)
        for (kind, number, written), new in zip(entities, found.groups(), strict=True):
            assert new != written and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", written) or kind in ("email", "iban"), (written, new)
            assert [c.isalpha() for c in new] == [c.isalpha() for c in written] and [c.isdigit() for c in new] == [c.isdigit() for c in written]
            assert [c.isupper() for c in new] == [c.isupper() for c in written]
            normal = re.sub(r"[^a-z0-9@.]", "", new.lower()) if kind == "email" else re.sub(r"[^A-Z0-9]", "", new)
            normal = normal[-10:] if kind == "phone" else normal
            assert book.setdefault((kind, number), normal) == normal  # coreference, however it is written
    assert len(book) == sum(map(len, ENTITIES.values()))
    for kind, groups in ENTITIES.items():
        own = [book[kind, n] for n in range(len(groups))]
        plain = {re.sub(r"[^A-Za-z0-9@.]", "", w) for g in groups for w in g}
        assert len(set(own)) == len(own) and not set(own) & plain
