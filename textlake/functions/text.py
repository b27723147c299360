"""URLs, titles, redaction and other text helpers."""

from __future__ import annotations

import functools

from pyspark.sql import Column, functions as F

from . import kernels

#: Query parameters that canonical URLs leave out, besides those that begin with utm_ (fixed values).
TRACKING = ("fbclid", "gclid", "mc_cid", "mc_eid")


def form_decoded(text: Column) -> Column:
    """Plus signs as blanks and percent codes as the bytes of UTF-8; what is no code stays, bytes that are no UTF-8 read as U+FFFD."""
    return F.url_decode(F.regexp_replace(text, "%(?![0-9A-Fa-f]{2})", "%25"))


def form_encoded(text: Column) -> Column:
    """Blanks as plus signs and all bytes of UTF-8 but letters, digits and ``_.-~`` as percent codes in capitals."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical_url(url: Column) -> Column:
    """Scheme and host in lower case, no user, default port, fragment or tracking parameters, ``/`` for no path.

    The query's names and values are decoded, sorted and encoded again, so that any two ways to write
    them give one URL. Null and texts without a scheme are null.
    """
    u = F.regexp_replace(F.regexp_replace(url, r"(?U)^[\s\x00-\x1f]+|\s+$", ""), r"[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1))
    place = F.lower(F.regexp_replace(F.regexp_extract(u, r"^[^:/?#]+://([^/?#]*)", 1), "^.*@", ""))
    port = F.regexp_replace(F.regexp_extract(place, r":([0-9]*)$", 1), "^0+", "")
    host = F.regexp_replace(place, ":[0-9]*$", "")
    usual = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    host = F.when(usual, host).otherwise(F.concat(host, F.lit(":"), port))
    path = F.regexp_extract(u, r"^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    pairs = F.filter(F.split(F.regexp_extract(u, r"^[^?#]*[?]([^#]*)", 1), "&"), lambda p: p != "")
    at = lambda p: F.instr(p, "=")
    decoded = F.transform(pairs, lambda p: F.struct(form_decoded(F.when(at(p) > 0, F.left(p, at(p) - 1)).otherwise(p)).alias("name"), form_decoded(F.when(at(p) > 0, F.substr(p, at(p) + 1)).otherwise("")).alias("value")))
    kept = F.filter(decoded, lambda d: ~F.lower(d["name"]).isin(*TRACKING) & ~F.lower(d["name"]).startswith("utm_"))
    query = F.array_join(F.transform(F.array_sort(kept), lambda d: F.concat(form_encoded(d["name"]), F.lit("="), form_encoded(d["value"]))), "&")
    return F.when(scheme != "", F.concat(scheme, F.lit("://"), host, F.when(path == "", "/").otherwise(path), F.when(query == "", "").otherwise(F.concat(F.lit("?"), query))))


#: References that every writer of markup escapes with; the ampersand's is last, so none is decoded twice.
MARKUP = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&amp;": "&"}


def normalize_title(title: Column, references: dict[str, str] | None = None) -> Column:
    """HTML entities decoded, NFC, blanks single.

    All of HTML's are decoded, as browsers do also without their semicolon (``&amp`` where a title was
    cut); with ``references`` only those, as they are written.
    """
    decoded = kernels.html_unescape(title) if references is None else functools.reduce(lambda t, kv: F.replace(t, *map(F.lit, kv)), references.items(), title)
    return F.trim(F.regexp_replace(kernels.nfc(decoded), r"[\s\x1c-\x1f\x85\p{Z}]+", " "))


def period_text(text: Column, length: int = 1000) -> Column:
    """NFKC, control and format characters as blanks, blanks single, at most ``length`` characters."""
    flat = F.regexp_replace(F.regexp_replace(kernels.nfkc(text), r"[\p{C}&&[^\t\n\r]]", " "), r"[\s\p{Z}]+", " ")
    return F.left(F.trim(flat), F.lit(length))


def keyword_hits(text: Column, keywords: tuple[str, ...]) -> Column:
    """Those of ``keywords`` that the text holds, case aside, in their order."""
    folded = F.lower(text)
    return F.filter(F.array(*map(F.lit, keywords)), lambda k: folded.contains(F.lower(k)))


#: What secrets look like and the marks that replace them, in order (fixed values).
SECRETS = {
    r"(?i)https://hooks\.slack\.com/services/[^\s'\"<>]+": "[REDACTED_SLACK_WEBHOOK]",
    r"(?i)(api[_-]?key|token|password|secret|authorization)\s*[:=]\s*([^\s,;]+)": "$1=[REDACTED]",
    r"\bsk-[A-Za-z0-9_-]{8,}\b": "[REDACTED_OPENAI_KEY]",
}


def redact(text: Column) -> Column:
    """Web hooks, credentials after a name, and keys replaced by marks."""
    return functools.reduce(lambda t, kv: F.regexp_replace(t, *kv), SECRETS.items(), text)


def scrub_nul(text: Column) -> Column:
    """NUL characters, which some stores refuse, as U+FFFD."""
    return F.replace(text, F.lit("\x00"), F.lit("�"))


def first_text(*choices: Column) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in choices])


def split_tags(tags: Column) -> Column:
    """Distinct trimmed tags of a comma-separated text; null gives none."""
    return F.array_distinct(F.filter(F.transform(F.split(F.coalesce(tags, F.lit("")), ","), lambda x: F.trim(x)), lambda t: t != ""))


def flat_line(text: Column) -> Column:
    return F.translate(text, "\r\n", "  ")


def safe_component(text: Column, length: int = 120) -> Column:
    """A text as part of a path: other characters than letters, digits, dot, dash and underscore become dashes."""
    return F.left(F.btrim(F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "-"), F.lit("-.")), F.lit(length))


def duration(seconds: Column) -> Column:
    """``1h 02m 03s``, without leading zero units."""
    s = F.greatest(seconds.cast("long"), F.lit(0).cast("long"))
    h, m, r = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return F.when(h > 0, F.format_string("%dh %02dm %02ds", h, m, r)).when(m > 0, F.format_string("%dm %02ds", m, r)).otherwise(F.format_string("%ds", r))
