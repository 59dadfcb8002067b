"""Scalar text functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters removed around a tag (Unicode white space plus the four ASCII separators).
TAG_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Extensions of still images, and what `include_videos` adds.
MEDIA_EXTENSIONS = (".jpg", ".jpeg", ".png", ".gif")
VIDEO_EXTENSIONS = (".mp4", ".webm")


def normalize_tag(tag: Column) -> Column:
    return F.btrim(F.lower(tag), F.lit(TAG_WHITESPACE))


def extension(path: Column) -> Column:
    """Lower-cased extension with its dot; an empty string where there is none."""
    tail = F.substring_index(path, ".", -1)
    return F.when(path.contains(".") & (tail != ""), F.concat(F.lit("."), F.lower(tail))).when(path.isNotNull(), F.lit(""))


def file_extension(path: Column) -> Column:
    """As ``extension`` for a listed file: a leading dot of the file name starts no extension."""
    return F.lower(F.regexp_extract(path, r"(?:^|/)\.*[^./][^/]*?(\.[^./]*)$", 1))


def allowed_extensions(include_videos: bool = False) -> tuple[str, ...]:
    return MEDIA_EXTENSIONS + VIDEO_EXTENSIONS if include_videos else MEDIA_EXTENSIONS


def has_media_extension(path: Column, include_videos: bool = False) -> Column:
    return F.coalesce(extension(path).isin(*allowed_extensions(include_videos)), F.lit(False))


def is_image(path: Column) -> Column:
    """Trainable stills only: gif counts as media but not as an image here."""
    return F.coalesce(path.rlike(r"(?i)\.(jpg|jpeg|png)$"), F.lit(False))


def parent_dir(path: Column) -> Column:
    return F.when(path.contains("/"), F.regexp_replace(path, r"/[^/]*$", "")).otherwise(F.lit("."))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def join_path(prefix: Column, path: Column) -> Column:
    return F.concat_ws("/", F.rtrim(prefix, F.lit("/")), path)


def base64_text(data: Column) -> Column:
    """Base64 on a single line; null for null or empty input."""
    return F.when(F.length(data) > 0, F.translate(F.base64(data), "\r\n", ""))


def percent(share: Column) -> Column:
    return F.format_string("%.1f%%", share * 100)


def _one_decimal(x: Column) -> Column:
    """``x`` with one decimal, rounded on its exact binary value (half to even), as C's ``%.1f`` does."""
    # A double prints as its shortest decimal, which can look like a tie it is not. Taking off a nearby multiple of
    # 1/64 is exact and leaves a remainder small enough for the deciding digits to show.
    near = F.floor(x * 64) / 64
    exact = near.cast("decimal(38,20)") + (x - near).cast("decimal(38,20)")
    return F.bround(exact.cast("decimal(37,20)"), 1).cast("decimal(30,1)").cast("string")


def human_bytes(size: Column) -> Column:
    x = size.cast("double")
    out = F.concat(_one_decimal(x / 1024**5), F.lit(" PB"))
    for power, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        scaled = x / 1024**power
        out = F.when(scaled < 1024, F.concat(_one_decimal(scaled), F.lit(f" {unit}"))).otherwise(out)
    return F.when(size.isNotNull(), out)


def human_duration(seconds: Column) -> Column:
    x = seconds.cast("double")
    minutes = x / 60
    return (
        F.when(x < 60, F.concat(_one_decimal(x), F.lit("s")))
        .when(minutes < 60, F.concat(_one_decimal(minutes), F.lit("m")))
        .when(x.isNotNull(), F.concat(_one_decimal(minutes / 60), F.lit("h")))
    )


def key_number_pairs(text: Column, keys: list[str]) -> Column:
    """Per key the number assigned to it in ``text`` (``KEY = 5``, ``key: 1 << 3``), as array<struct<key,value>>.

    A key may be written in capitals or in small letters. The last match wins; a shift form outranks a plain
    number, and within one form small letters outrank capitals. Numbers and shifts that a long cannot hold are no matches.
    """
    upper = "|".join(k.upper() for k in keys)
    lower = "|".join(k.lower() for k in keys)

    def matches(names: str, tail: str, shifted: bool) -> Column:
        pattern = F.lit(rf"\b({names})\b\s*[:=]\s*{tail}")
        number = lambda s: s.try_cast("long")
        zipped = F.arrays_zip(
            F.regexp_extract_all(text, pattern, F.lit(1)).alias("k"),
            F.regexp_extract_all(text, pattern, F.lit(2)).alias("v"),
        )
        return F.transform(
            zipped,
            lambda m: F.struct(
                F.upper(m["k"]).alias("key"),
                (F.pow(F.lit(2), number(m["v"])).try_cast("long") if shifted else number(m["v"])).alias(
                    "value"
                ),
            ),
        )

    found = F.concat(
        matches(upper, r"(\d+)", False),
        matches(lower, r"(\d+)", False),
        matches(upper, r"1\s*<<\s*(\d+)", True),
        matches(lower, r"1\s*<<\s*(\d+)", True),
    )
    names = F.array(*[F.lit(k.upper()) for k in keys])
    last = lambda found: F.transform(names, lambda k: F.try_element_at(F.filter(found, lambda m: (m["key"] == k) & m["value"].isNotNull()), F.lit(-1)))
    # The matches are bound by an outer function, as an inner one would look for them again at every key.
    return F.flatten(F.transform(F.array(found), lambda all_: F.filter(last(all_), lambda m: m.isNotNull())))


def resolve_url(base: Column, ref: Column) -> Column:
    """``ref`` as an absolute URL relative to ``base``."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*:)", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    no_fragment = F.regexp_replace(base, r"#.*$", "")
    no_query = F.regexp_replace(base, r"[?#].*$", "")
    base_path = F.regexp_replace(no_query, r"^[a-zA-Z][a-zA-Z0-9+.\-]*://[^/]*", "")
    folder = F.regexp_extract(base_path, r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    path = F.regexp_extract(ref, r"^([^?#]*)", 1)
    tail = F.regexp_extract(ref, r"^[^?#]*(.*)$", 1)
    full = F.when(path.startswith("/"), path).otherwise(F.concat(folder, path))
    return (
        F.when(ref == "", no_fragment)
        .when(ref.rlike(r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"), ref)
        .when(ref.startswith("//"), F.concat(scheme, ref))
        .when(ref.startswith("#"), F.concat(no_fragment, ref))
        .when(ref.startswith("?"), F.concat(no_query, ref))
        .otherwise(F.concat(origin, _without_dot_segments(full), tail))
    )


def _without_dot_segments(path: Column) -> Column:
    parts = F.slice(F.split(path, "/"), 2, 2_000_000)
    kept = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, seg: F.when(seg == "..", F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
        .when(seg == ".", acc)
        .otherwise(F.concat(acc, F.array(seg))),
    )
    ends_in_dots = path.rlike(r"/\.{1,2}$")
    joined = F.concat(F.lit("/"), F.array_join(kept, "/"))
    has_dots = path.rlike(r"/\.{1,2}(/|$)")
    return F.when(~has_dots, path).otherwise(
        F.when(ends_in_dots & (F.size(kept) > 0), F.concat(joined, F.lit("/"))).otherwise(joined)
    )


def attribute_urls(html: Column, base: Column, tag: str, attribute: str, suffix: str = "", limit: int = 20) -> Column:
    """The first ``limit`` values of ``<tag attribute=...>`` ending in ``suffix``, made absolute."""
    found = F.regexp_extract_all(html, F.lit(rf"<{tag}[^>]+{attribute}=[\"']([^\"']+)[\"']"), F.lit(1))
    if suffix:
        found = F.filter(found, lambda u: u.endswith(suffix))
    return F.transform(F.slice(found, 1, limit), lambda u: resolve_url(base, u))
