"""URL columns: host, path, identities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Hosts by kind.
PAPER_HOSTS = ("arxiv.org", "papers.cool", "alphaxiv.org")
REVIEW_HOST = "openreview.net"
X_HOSTS = ("x.com", "twitter.com")
VIDEO_HOSTS = ("youtube.com", "youtu.be")
CODE_HOSTS = ("github.com", "gist.github.com")


def netloc(url: Column) -> Column:
    """Authority in lower case, port kept."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1))


def url_host(url: Column) -> Column:
    return F.regexp_replace(netloc(url), r"^www\.", "")


def url_path(url: Column) -> Column:
    raw = F.regexp_extract(
        F.coalesce(url, F.lit("")), r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1
    )
    return F.regexp_replace(raw, ";[^/]*$", "")


def path_parts(url: Column) -> Column:
    return F.filter(F.split(url_path(url), "/"), lambda part: part != "")


def query_value(url: Column, name: str) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), rf"^[^?#]*\?(?:[^#]*&)?{name}=([^&#]*)", 1)


def part(parts: Column, index: int) -> Column:
    """Element counted from 1 (or from the end when negative); empty string when missing."""
    return F.coalesce(F.try_element_at(parts, F.lit(index)), F.lit(""))


def source_name(source: Column, url: Column) -> Column:
    """Trimmed source, else the host, else ``unknown``."""
    named = F.trim(F.coalesce(source, F.lit("")))
    host = url_host(url)
    return F.when(named != "", named).when(host != "", host).otherwise("unknown")


def source_candidates(source: Column, url: Column) -> Column:
    """Lookup keys of a row, most specific first."""
    named = F.lower(F.trim(F.coalesce(source, F.lit(""))))
    host = url_host(url)
    labels = F.split(host, r"\.")
    tail = F.when(F.size(labels) >= 2, F.array_join(F.slice(labels, -2, 2), "."))
    has_source = F.coalesce(source, F.lit("")) != ""
    return F.array_compact(F.array(
        F.when(has_source, named),
        F.when(has_source, F.replace(named, F.lit("_"), F.lit(" "))),
        F.when(has_source, F.replace(named, F.lit(" "), F.lit("_"))),
        F.when(host != "", host),
        F.when(host != "", tail),
    ))


def source_identity(source: Column, url: Column) -> Column:
    """The independent body behind a link: repository, account, subreddit, paper, else the host."""
    raw = F.trim(F.coalesce(url, F.lit("")))
    host, parts = url_host(raw), path_parts(raw)
    none = F.size(parts) == 0
    first_two = F.concat_ws("/", host, F.array_join(F.slice(parts, 1, 2), "/"))
    is_file = F.lower(raw).startswith("file:")
    return (
        F.when(is_file, F.when(url_path(raw) != "", url_path(raw)).otherwise(source_name(source, raw)))
        .when(host.isin(*CODE_HOSTS, "huggingface.co"), F.when(none, host).otherwise(first_two))
        .when(host.isin(*X_HOSTS), F.when(none, host).otherwise(F.concat_ws("/", host, part(parts, 1))))
        .when(host == "reddit.com",
              F.when((F.size(parts) >= 2) & (part(parts, 1) == "r"), first_two).otherwise(host))
        .when(host.isin(*VIDEO_HOSTS), F.lit("youtube.com"))
        .when(host.isin(*PAPER_HOSTS, REVIEW_HOST),
              F.when(none, host).otherwise(F.concat_ws("/", host, part(parts, -1))))
        .when(host != "", host)
        .otherwise(F.lower(source_name(source, raw)))
    )


def paper_identity(arxiv_id: Column, url: Column) -> Column:
    """Paper id without version: explicit id, else from a paper host; empty when the row is no paper."""
    host, parts = url_host(url), path_parts(url)
    unversioned = lambda value: F.trim(F.regexp_replace(F.lower(value), r"v\d+$", ""))
    note = query_value(url, "id")
    return (
        F.when(F.coalesce(arxiv_id, F.lit("")) != "", unversioned(arxiv_id))
        .when(host.isin(*PAPER_HOSTS) & (F.size(parts) > 0), unversioned(part(parts, -1)))
        .when(host == REVIEW_HOST, F.trim(F.lower(F.when(note != "", note).otherwise(part(parts, -1)))))
        .otherwise("")
    )


def repo_identity(source: Column, url: Column) -> Column:
    """owner/repo of a code-host row, else empty."""
    parts = path_parts(url)
    is_repo = (F.lower(F.coalesce(source, F.lit(""))) == "github") & (url_host(url) == "github.com") & (F.size(parts) >= 2)
    return F.when(is_repo, F.lower(F.concat_ws("/", part(parts, 1), part(parts, 2)))).otherwise("")


def _title_and_url(title: Column, url: Column) -> Column:
    return F.lower(F.concat_ws(" ", F.coalesce(title, F.lit("")), F.coalesce(url, F.lit(""))))


def is_release_post(title: Column, url: Column) -> Column:
    text = _title_and_url(title, url)
    return text.contains("[release]") | text.contains("/releases/")


def is_repo_homepage(source: Column, title: Column, url: Column) -> Column:
    return (repo_identity(source, url) != "") & (F.size(path_parts(url)) == 2) & ~is_release_post(title, url)


def normalise_url(url: Column) -> Column:
    return F.rtrim(F.coalesce(url, F.lit("")), F.lit("/"))


def uploads_playlist(channel_id: Column) -> Column:
    return F.when(channel_id.startswith("UC"), F.concat(F.lit("UU"), F.substr(channel_id, F.lit(3)))).otherwise(channel_id)


def video_id(url: Column) -> Column:
    """Eleven-character video id of a watch link, null when there is none."""
    return F.nullif(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?:v=|youtu\.be/)([a-zA-Z0-9_-]{11})", 1), F.lit(""))


def heat_is_open(status: Column) -> Column:
    """2xx and 3xx are open; 401, 403 and 429 mean a guarded page, not a dead one."""
    return status.between(200, 399) | status.isin(401, 403, 429)


def percent_encode(url: Column) -> Column:
    """Encode what breaks a plain Markdown destination; reserved characters stay."""
    encoded = F.url_encode(F.trim(url))
    # form encoding writes a space as + and reserved characters as %XX: undo both
    out = F.replace(encoded, F.lit("+"), F.lit("%20"))
    for char, code in _SAFE:
        out = F.replace(out, F.lit(code), F.lit(char))
    return out


# Characters that stay as they are in a destination (besides letters, digits and -._~).
_SAFE = [
    (":", "%3A"), ("/", "%2F"), ("?", "%3F"), ("#", "%23"), ("@", "%40"), ("!", "%21"), ("$", "%24"),
    ("&", "%26"), ("'", "%27"), (",", "%2C"), (";", "%3B"), ("=", "%3D"), ("+", "%2B"), ("~", "%7E"),
    ("%", "%25"),
]
