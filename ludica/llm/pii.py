"""Personal data (operator 13): patterns propose, checksums confirm, context words adjust the score.

Built-in functions only. For each kind, ``regexp_extract_all`` gives the matches of
a text and ``split`` by the same pattern what lies between them, so running
sums of their lengths are the matches' positions (code points; end exclusive), in one pass
each over the text and without a row for each match.

Base spans (email, ip, card, phone) are those of the fixed patterns that pass
their check: parts up to 255, Luhn, numbers of digits. They stay whatever their
score. Patterns are written so that no text takes more than a few steps
a character: a match begins where a run of its characters begins, runs are
taken possessively, and repeated groups are possessive as well, which Java runs
as a loop and not as a recursion.

Beyond these, candidates are proposed and scored: PRIOR, plus CHECKSUM where a check
digit confirms them (mod-97 for an iban of its country's length, Luhn for a
card in dotted groups) or FORMAT where only the form can be checked (ssn, phone
number without a plus), plus CONTEXT where a word for the kind stands nearby
(within BEFORE code points before or AFTER after it, not beyond the next match). Spans of
THRESHOLD or more are added unless they overlap a base span.

Defined cases: null text is empty text; empty text and text without a match have
no span (an empty list, the digest of the empty string); repeated rows and
null ids: every row stands for itself; other columns are ignored.
"""

from __future__ import annotations

import operator
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRIOR, CHECKSUM, FORMAT, CONTEXT, THRESHOLD = 0.3, 0.4, 0.1, 0.3, 0.65
#: Code points around a match in which context words count.
BEFORE, AFTER = 50, 20
#: Running sums go over so many entries at a time.
_CHUNK = 256
#: In the order of their spans at one start.
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
#: Length of an IBAN by country (fixed values of the public registry).
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FO": 18, "FR": 27,
    "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19,
    "MR": 27, "MT": 31, "MU": 30, "NL": 18, "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20}


class _Proposal(NamedTuple):
    """gate: what a text must hold for the pattern to be tried at all."""

    name: str
    kind: str
    pattern: str
    gate: str
    words: str


#: ASCII word boundaries.
_B, _E = r"(?<![A-Za-z0-9_])", r"(?![A-Za-z0-9_])"
_CARD_WORDS = r"card|credit|visa|mastercard|karte|tarjeta|carte"
_PHONE_WORDS = r"phone|call|tel[^a-z]|fax|mobile|telefon|teléfono|téléphone|anruf|llam|appel"
BASE = (
    _Proposal("email", "email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@",
              r"mail|contact|kontakt|correo|courriel|write|schreib|escrib"),
    _Proposal("ip", "ip", r"[0-9](?<![0-9][0-9])[0-9]*+\.[0-9]++\.[0-9]++\.[0-9]++", ".", r"[^a-z]ip[^a-z]|address|server|host|adresse|direcci"),
    _Proposal("card", "card", r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?+[0-9]){11,18}+(?![ -]?[0-9])", "", _CARD_WORDS),
    _Proposal("phone", "phone", r"\+[0-9][ ().0-9-]+[0-9]", "+", _PHONE_WORDS),
)
ADDED = (
    _Proposal("dotted", "card", _B + r"[0-9]{4}\.[0-9]{4}\.[0-9]{4}\.[0-9]{4}" + _E, ".", _CARD_WORDS),
    _Proposal("national", "phone", _B + r"0[0-9]{1,4}[ /.-][0-9]{3,4}(?:[ .-]?[0-9]{2,4}){1,3}" + _E, "0", _PHONE_WORDS),
    _Proposal("iban", "iban", _B + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}" + _E, "", r"iban|account|konto|cuenta|compte|bank|banque|banco"),
    _Proposal("ssn", "ssn", _B + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _E, "-", r"ssn|social security|sozialversicherung|seguridad social|sécurité sociale"),
)
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base and added: arrays of (start, kind_at, end, score, value, checked,
    added) by start and kind; kind_at is the place in KINDS."""
    df = docs.select(F.col(id_col), F.coalesce(text_col, F.lit("")).alias("text"))
    every = BASE + ADDED
    none = F.array().cast("array<string>")
    tried = [F.when(F.col("text").contains(p.gate), F.regexp_extract_all("text", F.lit(p.pattern), F.lit(0))).otherwise(none)
             .alias(f"hits_{p.name}") for p in every]
    df = df.select(id_col, "text", *tried)
    gaps = [F.when(F.size(f"hits_{p.name}") > 0, F.split("text", p.pattern, -1)).otherwise(none).alias(f"gaps_{p.name}") for p in every]
    df = df.select(id_col, *[f"hits_{p.name}" for p in every], *gaps)
    df = df.select(id_col, *[c for p in every for c in (F.col(f"hits_{p.name}"), F.col(f"gaps_{p.name}"),
                                                        _steps(p.name).alias(f"steps_{p.name}"))])
    df = df.select(id_col, *[c for p in every for c in (F.col(f"hits_{p.name}"), F.col(f"gaps_{p.name}"),
                                                        _running(f"steps_{p.name}", operator.add).alias(f"ends_{p.name}"))])
    df = df.select(id_col, *[_scored(p).alias(p.name) for p in every])
    base = F.concat(*[F.filter(p.name, lambda s: s["checked"]) for p in BASE])
    more = F.concat(*[F.filter(p.name, lambda s: s["score"] >= THRESHOLD) for p in ADDED])
    df = df.select(id_col, F.array_sort(base).alias("base"), F.array_sort(F.concat(base, more)).alias("every"))
    # the farthest end of the base spans up to a span, and the nearest start of those from it on
    far = F.lit(1 << 62).cast("long")
    df = df.select(id_col, "base", "every",
                   F.transform("every", lambda s: F.when(s["added"], F.lit(0).cast("long")).otherwise(s["end"])).alias("ends"),
                   F.reverse(F.transform("every", lambda s: F.when(s["added"], far).otherwise(s["start"]))).alias("starts"))
    df = df.select(id_col, "base", "every", _running("ends", F.greatest).alias("ends"),
                   F.reverse(_running("starts", F.least)).alias("starts"))
    free = F.filter(F.arrays_zip("every", "ends", "starts"), lambda z: z["every"]["added"] & (
        z["ends"] <= z["every"]["start"]) & (z["starts"] >= z["every"]["end"]))
    return df.select(id_col, "base", F.transform(free, lambda z: z["every"]).alias("added"))


def digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind_at"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")
    everything = F.when(F.size("added") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", "added")))
    return found.select(id_col, *[count(k) for k in ("email", "ip", "card", "phone")],
                        F.sha2(_listed(F.col("base")), 256).alias("base_sha256"), _listed(everything).alias("spans"))


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind_at"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _steps(name: str) -> Column:
    """From the end of one match to the end of the next."""
    return F.transform(f"hits_{name}", lambda h, i: (F.length(F.get(F.col(f"gaps_{name}"), i)) + F.length(h)).cast("long"))


def _running(column: str, op: Callable[[Column, Column], Column]) -> Column:
    """Running results of ``op``, over chunks and over the chunks' last ones,
    since adding to an array copies it. An expression in place of a column would be worked out anew for each chunk."""
    def running(values: Column) -> Column:
        return F.aggregate(values, F.array().cast("array<bigint>"), lambda done, x: F.concat(
            done, F.array(F.coalesce(op(F.try_element_at(done, F.lit(-1)), x), x))))

    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(column) - 1) / _CHUNK).cast("int")),
                         lambda c: running(F.slice(column, c * _CHUNK + 1, F.lit(_CHUNK))))
    lasts = running(F.transform(chunks, lambda c: F.element_at(c, -1)))
    before = F.concat(F.array(F.lit(None).cast("bigint")), F.slice(lasts, F.lit(1), F.floor((F.size(column) - 1) / _CHUNK).cast("int")))
    whole = F.flatten(F.zip_with(chunks, before, lambda c, b: F.transform(c, lambda x: F.when(b.isNull(), x).otherwise(op(b, x)))))
    return (F.when(F.size(column) == 0, F.array().cast("array<bigint>"))
            .when(F.size(column) <= _CHUNK, running(F.col(column))).otherwise(whole))


def _scored(p: _Proposal) -> Column:
    """(start, kind_at, end, score, value, checked, added) of each match."""
    hits, gaps, ends = (F.col(f"{part}_{p.name}") for part in ("hits", "gaps", "ends"))

    def span(hit: Column, i: Column) -> Column:
        kept = _iban(hit) if p.kind == "iban" else hit
        start = F.get(ends, i) - F.length(hit)
        checked = F.coalesce(_confirmed(p.name, kept), F.lit(False))
        near = (F.right(F.get(gaps, i), F.lit(BEFORE)).rlike(f"(?iu)(?:{p.words})")
                | F.left(F.get(gaps, i + 1), F.lit(AFTER)).rlike(f"(?iu)(?:{p.words})"))
        strength = CHECKSUM if p.name in ("card", "dotted", "iban") else FORMAT
        points = F.when(checked, round(10 * strength)).otherwise(0) + F.when(near, round(10 * CONTEXT)).otherwise(0)
        return F.struct(start.alias("start"), F.lit(KINDS.index(p.kind)).alias("kind_at"),
                        (start + F.length(kept)).alias("end"), ((points + round(10 * PRIOR)) / 10).alias("score"),
                        kept.alias("value"), checked.alias("checked"), F.lit(p in ADDED).alias("added"))
    return F.transform(hits, span)


def _confirmed(name: str, hit: Column) -> Column:
    digits = F.translate(hit, "+ ().-/", "")
    if name == "ip":
        return hit.rlike(rf"^{_BYTE}\.{_BYTE}\.{_BYTE}\.{_BYTE}$")
    if name in ("card", "dotted"):
        return F.call_function("luhn_check", digits)
    if name == "phone":
        return F.length(digits).between(9, 15)
    if name == "national":
        return F.length(digits).between(9, 12)
    if name == "iban":
        return _mod_97(F.replace(hit, F.lit(" "), F.lit(""))) == 1
    if name == "ssn":
        return ~hit.rlike("^000|^666|^9|-00-|-0000$")
    return F.lit(True)


def _iban(hit: Column) -> Column:
    """The part of the match that has the length of its country's numbers: a
    word in capitals may follow. The whole match where there is none."""
    lengths = F.create_map(*[F.lit(v) for pair in IBAN_LENGTHS.items() for v in pair])
    size = F.coalesce(F.get(F.filter(F.sequence(F.lit(1), F.length(hit)), lambda i: (
        F.length(F.replace(F.left(hit, i), F.lit(" "), F.lit(""))) == F.try_element_at(lengths, F.left(hit, F.lit(2))))
        & ((i == F.length(hit)) | (F.substr(hit, i + 1, F.lit(1)) == " "))), F.lit(0)), F.length(hit))
    return F.left(hit, size)


def _mod_97(iban: Column) -> Column:
    """The number of an IBAN (letters as 10 to 35, the first four characters last) modulo 97; null for a wrong length."""
    lengths = F.create_map(*[F.lit(v) for pair in IBAN_LENGTHS.items() for v in pair])
    turned = F.concat(F.substr(iban, F.lit(5)), F.left(iban, F.lit(4)))
    rest = F.aggregate(F.split(turned, ""), F.lit(0), lambda done, c: F.when(
        c.rlike("[0-9]"), (done * 10 + F.ascii(c) - 48) % 97).otherwise((done * 100 + F.ascii(c) - 55) % 97))
    return F.when(F.length(iban) == F.try_element_at(lengths, F.left(iban, F.lit(2))), rest)
