"""URL expressions. All are built-in column expressions, so they run inside generated code.

An expression that is used twice is generated twice, so each step here refers to the step
before it once or twice at most. Patterns give nothing back once it is matched (`?+`, `*+`), so
a URL that does not match is left early.
"""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagelode import options as O

_NAME = r"[A-Za-z][A-Za-z0-9+.-]*+"
_SCHEME = rf"(?:{_NAME}:)?+"
_HOST = r"(?://[^/?#]*+)?+"
_PATH_END = r"(?=[?#]|\z)"
# A host with an opening and no closing bracket, or the reverse, is no host.
_BRACKETS = r"(?:(?=[^/?#\[\]]*(?:[/?#]|\z))|(?=[^/?#]*\[)(?=[^/?#]*\]))"
# The blanks a URL may start with, and the characters dropped anywhere in it.
_LEADING = "".join(chr(c) for c in range(1, 33))
_DROPPED = "\t\r\n"
# Schemes that are followed by a host.
_HOST_SCHEMES = (
    r"ftp|http|gopher|nntp|telnet|imap|wais|file|mms|https|shttp|snews|prospero|rtsp|rtsps|rtspu|rsync|svn|svn\+ssh"
    r"|sftp|nfs|git|git\+ssh|ws|wss|itms-services"
)
# Schemes whose last path segment may carry `;params`.
_PARAM_SCHEMES = "ftp|hdl|prospero|http|imap|https|shttp|rtsp|rtsps|rtspu|sip|sips|mms|sftp|tel"
# The start of a URL of such a scheme, or of none.
_PARAM_START = rf"(?:(?i:{_PARAM_SCHEMES}):|(?!{_NAME}:))"
# A web URL that normalising would not change.
_NORMAL = r"^https?://[^/?#\x00-\x20]+(?:[/?][^#\x00-\x20]*)?(?<![/?])\z"


def _contains_any(text: Column, parts) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(p)) for p in parts), F.lit(False))


def _one_of(parts) -> str:
    """A pattern for any of these texts. Texts with capitals cannot occur in a lower-cased one."""
    return "|".join(re.escape(p) for p in parts if p == p.lower()) or r"(?!)"


def prepared(url: Column) -> Column:
    """Without leading blanks and embedded line ends; most URLs have none, and one pattern tells."""
    return F.when(url.rlike(r"[\x00-\x20]"), F.ltrim(F.translate(url, _DROPPED, ""), F.lit(_LEADING))).otherwise(url)


def clean_url(url: Column) -> Column:
    """Text before the first `#`, without trailing slashes."""
    return F.rtrim(F.split_part(url, F.lit("#"), F.lit(1)), F.lit("/"))


def normalize_url(url: Column) -> Column:
    """The identity of a URL in the frontier; null and empty become ''."""
    # No fragment, no empty query; a non-empty query stays.
    bare = F.regexp_replace(F.split_part(prepared(url), F.lit("#"), F.lit(1)), r"^([^?]*)\?\z", "$1")
    lowered = F.concat(F.lower(F.regexp_extract(bare, rf"^{_SCHEME}", 0)), F.regexp_replace(bare, rf"^{_NAME}:", ""))
    # An empty host: schemes with hosts are written out with all three slashes, without such a
    # scheme the slashes of the host are left out.
    filled = F.regexp_replace(lowered, rf"^({_HOST_SCHEMES}):/(?=[^/])", "$1:///")
    filled = F.regexp_replace(filled, rf"^((?!(?:{_HOST_SCHEMES}):){_NAME}:)?//(?=\?|/(?!/)|\z)", "$1")
    # Most URLs are in normal form already, and one pattern tells.
    return F.when(url.rlike(_NORMAL), url).otherwise(F.coalesce(F.rtrim(filled, F.lit("/")), F.lit("")))


def netloc(url: Column) -> Column:
    """Lower-cased authority with user and port; '' when there is none or brackets are broken."""
    found = F.regexp_extract(prepared(url), rf"^{_SCHEME}//{_BRACKETS}([^/?#]*)", 1)
    return F.coalesce(F.lower(found), F.lit(""))


url_domain = netloc


def url_path(url: Column) -> Column:
    """Path without the `;params` of its last segment."""
    whole = rf"^{_SCHEME}{_HOST}([^?#]*)"
    cut = rf"^{_SCHEME}{_HOST}([^?#]*?)(?:;[^/?#]*)?{_PATH_END}"
    text = prepared(url)
    return F.when(text.rlike(rf"^{_PARAM_START}"), F.regexp_extract(text, cut, 1)).otherwise(
        F.regexp_extract(text, whole, 1))


def last_segment(url: Column) -> Column:
    return F.regexp_extract(url_path(url), r"([^/]*)/*\z", 1)


def url_extension(url: Column) -> Column:
    """Lower-cased text after the last dot of the URL, '' without a dot in the last segment."""
    return F.regexp_extract(F.lower(url), r"\.([^./]*)\z", 1)


def valid_url(url: Column, domains=O.VALID_DOMAINS) -> Column:
    """http(s), with a host, and some allowed text inside the host."""
    return F.coalesce(prepared(url).rlike(rf"(?i)^https?://{_BRACKETS}(?=[^/?#])[^/?#]*?(?:{_one_of(domains)})"), F.lit(False))


def junk_url(url: Column, patterns=O.JUNK_PATTERNS) -> Column:
    return F.coalesce(_contains_any(F.lower(url), patterns), F.lit(False))


def trusted_url(url: Column, domains=O.TRUSTED_DOMAINS) -> Column:
    """Allowed text anywhere in the URL. Looser than `valid_url`, which looks at the host only."""
    return F.coalesce(_contains_any(F.lower(url), domains), F.lit(False))


# URLs whose path is `/wiki/` and digits. This and the next are tested after a quicker pattern
# that few URLs pass.
_WIKI_NUMBER = (
    rf"(?U)^(?:{_SCHEME}{_HOST}/wiki/\d++{_PATH_END}|{_PARAM_START}{_HOST}/wiki/\d++;[^/?#]*+{_PATH_END})")
# URLs whose path ends in a segment of one or two characters. Slashes may follow; params may
# too, and are no part of the segment they follow.
_SHORT_SEGMENT = (
    rf"^(?:{_PARAM_START}{_HOST}(?:[^?#]*/)?(?:[^/?#;]{{1,2}}|[^/?#]{{1,2}}/++)(?:;[^/?#]*+)?"
    rf"|(?!{_PARAM_START}){_SCHEME}{_HOST}(?:[^?#]*/)?[^/?#]{{1,2}}/*+){_PATH_END}")


def url_verdict(url: Column, max_length: int = O.MAX_URL_LENGTH, low: Column | None = None,
                text: Column | None = None) -> Column:
    """Reason of the first rule that rejects the URL, or 'ok'.

    There is a counter for `year_page`, but no URL gets there: `numeric_page` takes them all.
    `low` and `text` are the lower-cased and the prepared URL where they are at hand as columns.
    """
    low = F.lower(url) if low is None else low
    text = prepared(url) if text is None else text
    return (
        F.when(url.isNull() | (url == ""), "empty")
        .when(F.length(url) > max_length, "url_length")
        .when(F.contains(url, F.lit("?")), "query_params")
        .when(low.rlike(rf"\.(?:{_one_of(O.BLOCKED_EXTENSIONS)})\z"), "extension")
        .when(low.rlike(f":(?<={_one_of(O.BLOCKED_NAMESPACES)})"), "namespace")  # all end in a colon
        .when(low.rlike(r"(?s)^(?!https?://en\.).*\.wikipedia\.org"), "non_en_wikipedia")
        .when(text.rlike(r"(?U)/wiki/\d") & text.rlike(_WIKI_NUMBER), "numeric_page")
        .when(_contains_any(low, ("list_of", "list%5fof")), "list_page")
        # With or without brackets around the word, a bracket must be there.
        .when(F.contains(url, F.lit("(")) & F.contains(low, F.lit("disambiguation")), "disambiguation")
        .when(F.contains(low, F.lit("timeline")), "timeline")
        .when((text.rlike(r"(?:^|[/:])[^/]{1,2}(?:[/;#?]|\z)") & text.rlike(_SHORT_SEGMENT))
              | (percent_count(url) > 5), "low_quality")
        .otherwise("ok")
    )


def percent_count(url: Column) -> Column:
    return F.length(url) - F.length(F.replace(url, F.lit("%"), F.lit("")))


def url_priority(url: Column, depth: Column, article_bonus: str = "whole") -> Column:
    """Score of a link found at `depth`; lower goes first.

    The bonus for article paths needs a URL without any colon, so with 'whole' no absolute
    URL ever gets it. 'path' tests only what follows the host.
    """
    # Something of the tested text before `/wiki/`, `/wiki/` itself and the rest, all without a colon.
    start = "^" if article_bonus == "whole" else rf"^(?:{_SCHEME}//[^/]*)?"
    article = F.lower(url).rlike(rf"(?s){start}[^:]*/wiki/[^:]*\z")
    return (
        depth + F.lit(1)
        + F.when(junk_url(url), 10000).otherwise(0)
        - F.when(article, 1).otherwise(0)
    ).cast("double")


@F.pandas_udf(T.StringType())
def _joined(base: pd.Series, href: pd.Series) -> pd.Series:
    def one(b, h):
        if b is None or h is None:
            return None
        try:
            return urljoin(b, h)
        except ValueError:
            return None
    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)


def resolve_url(base: Column, href: Column) -> Column:
    """The href as an absolute URL. Plain shapes stay in generated code; only references with
    dot segments, blanks or odd schemes are sent to Python."""
    plain = ~href.rlike(r"[\x00-\x20\[\]]|\?(#|\z)|#\z") & base.rlike(r"^https?://[^/?#\x00-\x20]+[^\x00-\x20]*\z")
    dots = F.regexp_replace(href, r"[?#].*\z", "").rlike(r"(^|/)\.{1,2}(/|\z)")
    root = F.regexp_extract(base, r"^(https?://[^/?#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    native = (
        F.when(href == "", base)
        .when(plain & href.rlike(r"^https?://[^/?#]+"), href)
        .when(plain & href.rlike(r"^//[^/?#]+"), F.concat(F.split_part(base, F.lit("//"), F.lit(1)), href))
        .when(plain & href.rlike(r"^/([^/]|\z)") & ~dots, F.concat(root, href))
        .when(plain & href.startswith("?"), F.concat(no_query, href))
        .when(plain & href.startswith("#") & ~base.rlike(r"\?(#|\z)"),
              F.concat(F.split_part(base, F.lit("#"), F.lit(1)), href))
    )
    rest = native.isNull() & base.isNotNull() & href.isNotNull()
    return F.coalesce(native, _joined(F.when(rest, base), F.when(rest, href)))
