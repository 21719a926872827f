"""Whole texts that are known licences, found by the digest of their canonical form.

Canonical form: lines that only state a copyright go, letters are lower-cased, punctuation and
white space separate words, and words with several usual spellings take one of them. Texts with
equal SHA-256 of that form are equal for this purpose, so one hash join finds them.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.llm.common import unused_name, with_struct
from tickloom.llm.license_texts import KNOWN_DIGESTS, KNOWN_LICENSES

# Spellings that licence matching treats as equal, by the word to use.
EQUIVALENT = {
    "acknowledgement": "acknowledgment",
    "acknowledgements": "acknowledgments",
    "analogue": "analog",
    "analyse": "analyze",
    "artefact": "artifact",
    "authorisation": "authorization",
    "authorise": "authorize",
    "authorised": "authorized",
    "calibre": "caliber",
    "cancelled": "canceled",
    "capitalisations": "capitalizations",
    "catalogue": "catalog",
    "categorise": "categorize",
    "centre": "center",
    "emphasised": "emphasized",
    "favour": "favor",
    "favourite": "favorite",
    "fulfil": "fulfill",
    "fulfilment": "fulfillment",
    "https": "http",
    "initialise": "initialize",
    "judgement": "judgment",
    "labelling": "labeling",
    "labour": "labor",
    "licence": "license",
    "licences": "licenses",
    "licenced": "licensed",
    "licencing": "licensing",
    "maximise": "maximize",
    "modelled": "modeled",
    "modelling": "modeling",
    "offence": "offense",
    "optimise": "optimize",
    "organisation": "organization",
    "organise": "organize",
    "practise": "practice",
    "programme": "program",
    "realise": "realize",
    "recognise": "recognize",
    "signalling": "signaling",
    "utilisation": "utilization",
    "whilst": "while",
    "wilful": "willful",
}
_PHRASES = ((b" copyright owner ", b" copyright holder "), (b" copyright owners ", b" copyright holders "),
            (b" non commercial ", b" noncommercial "), (b" per cent ", b" percent "), (b" sub license ", b" sublicense "))
_WORDS = {k.encode(): v.encode() for k, v in EQUIVALENT.items()}
# ASCII other than digits and letters separates words; A-Z become a-z.
_PLAIN = bytes(
    b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256)
)
# Typographic quotes, dashes and the like, which ASCII texts write with punctuation.
_TYPOGRAPHY = re.compile(r"[\u00a0\u00ab\u00bb\u2000-\u206f\u3000\ufeff]")
_START = rb"^[ \t\r/*#;%!.<>|-]*"
_SIGN = rb"(?:\(c\)|\xc2\xa9)"
# After "copyright" in clauses, whatever the line breaks: these words state no copyright.
_CLAUSE = (
    rb"(?!(?i:notices?|holders?|owners?|ownership|licen[cs]es?|laws?|acts?|statements?|interests?|disclaimers?|protection|treaty|"
    rb"permissions?|status|infringements?|rights?|materials?|information|management|and|or|in|is|to|for|of|on|under|"
    rb"(?:the[ \t]+)(?:software|program|work|library|document))\b)"
)
_NOTICE = re.compile(
    _START + rb"(?:"
    rb"(?i:(?:copyright\b|" + _SIGN + rb")[^\n]*(?:\d{4}|" + _SIGN + rb"|<|\[)|all rights reserved)"
    # Words before it: a sign or year must follow at once.
    rb"|(?i:(?:[a-z]+[ \t]+){1,5}copyright[ \t]*(?:" + _SIGN + rb"|(?:by[ \t]+[^\n]*)?(?:19|20)\d\d\b))"
    # No year: a name in capitals, or an ending that only notices have.
    rb"|(?:Copyright|COPYRIGHT)[ \t]*:?[ \t]+" + _CLAUSE + rb"(?:(?i:by)[ \t]+)?(?:(?i:the)[ \t]+)?[A-Z\x80-\xff]"
    rb"|(?i:(?:copyright\b[ \t]*:?[ \t]+" + _CLAUSE + rb"|" + _SIGN + rb")[^\n]*\b(?:authors|contributors|inc|ltd|llc|gmbh|all rights reserved)\b[. \t\r*/#]*$)"
    rb")[^\n]*$",
    re.MULTILINE,
)


def canonical(text: bytes | None) -> bytes:
    """The canonical form as words joined by one space."""
    lowered = text or b""
    if re.search(rb"copyright|\(c\)|\xc2\xa9|all rights reserved", lowered, re.IGNORECASE):
        lowered = _NOTICE.sub(b"", lowered)
    if b"\xe2\x80" in lowered or b"\xc2\xa0" in lowered or b"\xc2\xab" in lowered or b"\xc2\xbb" in lowered:
        lowered = _TYPOGRAPHY.sub(" ", lowered.decode()).encode()
    words = lowered.translate(_PLAIN).split()
    if not _WORDS.keys().isdisjoint(words):
        words = [_WORDS.get(w, w) for w in words]
    line = b" %b " % b" ".join(words)
    for seen, used in _PHRASES:
        line = line.replace(seen, used)
    return line.strip(b" ")


def digest(text: bytes | None) -> str:
    return hashlib.sha256(canonical(text)).hexdigest()


def known_digests(spark: SparkSession, licenses: dict[str, str] | None = None) -> DataFrame:
    """(license_id, digest) of the given licence texts, by default those of this package."""
    texts = KNOWN_LICENSES if licenses is None else licenses
    rows = [(digest(text.encode()), name) for name, text in texts.items()]
    rows = sorted(rows + ([(d, name) for name, own in KNOWN_DIGESTS.items() for d in own] if licenses is None else []))
    # Of two names for one canonical text the first in order counts.
    return spark.createDataFrame(list({d: (n, d) for d, n in reversed(rows)}.values()), "license_id string, digest string")


def license_digests(docs: DataFrame, name: str = "canon", keep: list[str] | None = None) -> DataFrame:
    """Add the struct ``name`` (digest, n_words) of the canonical form of whole texts.

    Null and empty texts have the digest of the empty string and 0 words.
    """

    def compute(texts: list[bytes | None]) -> list:
        forms = [canonical(t) for t in texts]
        return [[hashlib.sha256(f).hexdigest() for f in forms], [f.count(b" ") + 1 if f else 0 for f in forms]]

    fields = [T.StructField("digest", T.StringType()), T.StructField("n_words", T.LongType())]
    return with_struct(docs, "text", fields, compute, name, keep)


def scan_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, digest, license_id (null: not a known licence).

    ``known`` (license_id, digest) may be of any size; Spark broadcasts it only when it knows it
    to be small, and splits a digest that many documents share. Of several names with one digest
    the smallest counts. A text without words is never a licence. Repeated rows each get a row;
    other columns are left out.
    """
    known = known_digests(docs.sparkSession) if known is None else known
    known = known.groupBy(F.col("digest").alias("known_digest")).agg(F.min("license_id").alias("license_id"))
    made = license_digests(docs.select("doc_id", "text"), "canon", ["doc_id"])
    made = made.select("doc_id", "canon.n_words", "canon.digest")
    same = (F.col("digest") == F.col("known_digest")) & (F.col("n_words") > 0)
    return made.join(known, same, "left").select("doc_id", "n_words", "digest", "license_id")


def drop_licenses(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``docs`` without rows whose whole text is a known licence, all columns kept."""
    known = known_digests(docs.sparkSession) if known is None else known
    name = unused_name(docs, "canon")
    key = unused_name(docs, "known_digest")
    marked = license_digests(docs, name)
    same = (F.col(f"{name}.digest") == F.col(key)) & (F.col(f"{name}.n_words") > 0)
    return marked.join(known.select(F.col("digest").alias(key)).distinct(), same, "left_anti").drop(name)
