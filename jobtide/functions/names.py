"""Names: job names, labels, file stems, queue names, deterministic tokens."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from jobtide import fixed

# The character rules of job names and labels.  White space is what Unicode
# calls so, and the four separator control characters; plain ranges match much faster than a
# Unicode-aware character class.
_SPACE_SET = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_NAME_SET = "A-Za-z0-9-"
_LABEL_SET = r"A-Za-z0-9\-_."
_TRAILING = "[^a-z0-9]+$"
_LEADING = "^[^a-z0-9]+"
_NOT_WORD = "[^A-Za-z0-9_]"
# characters kept free for a dash and the number of a name that would occur twice
NUMBER_ROOM = 5


def kept_characters(text: Column, enough: int = fixed.JOB_NAME_LIMIT + 1) -> Column:
    """The first ``enough`` of the letters, digits and dashes of a text, in lower case.

    A run of white space becomes one dash.  The text is searched as far as it takes to find
    that many, to its end if need be; what lies behind them cannot change a name, so it is
    not rewritten.  ``enough`` is one more than a name may have, hence too long stays too long.
    """
    # the plain characters come first: they are by far the most frequent and quick to test
    other = rf"[^{_NAME_SET}{_SPACE_SET}]*+(?:[{_NAME_SET}]|[{_SPACE_SET}]++)"
    piece = rf"^(?:[{_NAME_SET}]|{other}){{0,{enough}}}+"
    found = F.regexp_extract(text, piece, 0)
    dashed = F.regexp_replace(found, f"[{_SPACE_SET}]+", "-")
    return F.lower(F.regexp_replace(dashed, f"[^{_NAME_SET}]+", ""))


def trim_name(kept: Column, limit: int = fixed.JOB_NAME_LIMIT) -> Column:
    """Cut at the limit, then drop dashes at either end."""
    cut = F.substring(kept, 1, limit)
    return F.regexp_replace(F.regexp_replace(cut, _TRAILING, ""), _LEADING, "")


def clean_name(text: Column, limit: int = fixed.JOB_NAME_LIMIT) -> Column:
    """Lower-case letters, digits and inner dashes only, at most ``limit`` long."""
    return trim_name(kept_characters(text), limit)


def safe_label(text: Column) -> Column:
    """Label characters only; from the length limit on it is cut and ends in dots.

    As for names, the text is searched until a full label is found or it ends.
    """
    piece = rf"^(?:[^{_LABEL_SET}]*+[{_LABEL_SET}]){{0,{fixed.LABEL_LIMIT}}}+"
    kept = F.regexp_replace(F.regexp_extract(text, piece, 0), f"[^{_LABEL_SET}]+", "")
    rest = fixed.LABEL_LIMIT - fixed.LABEL_KEEP
    too_long = f"^(.{{{fixed.LABEL_KEEP}}}).{{{rest},}}$"
    return F.regexp_replace(kept, too_long, "$1" + fixed.LABEL_ELLIPSIS)


def file_stem(kept_hint: Column) -> Column:
    """Clean name of the hint up to its first dot (no dot is left in it by now)."""
    return F.split_part(trim_name(kept_hint), F.lit("."), F.lit(1))


def digest(*parts: Column) -> Column:
    """The same hexadecimal text each time the same delivery is processed."""
    filled = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws("|", *filled), 256)


def token(length: int, digest: Column) -> Column:
    """Letters and digits from a digest: its first 60 bits in base 36, at most ten of them."""
    digits = F.lower(F.conv(F.substring(digest, 1, 15), 16, 36))
    return F.right(F.lpad(digits, 12, "0"), F.lit(length))


def name_hint(fallback: Column, *candidates: Column) -> Column:
    """First candidate that is present; an empty text counts as present."""
    return F.coalesce(*candidates, fallback)


def job_name(kept_hint: Column, suffix: Column, keep_suffix: bool = True) -> Column:
    """Prefix, hint (its kept characters) and suffix as one clean name.

    With ``keep_suffix`` a long hint is shortened so that the suffix survives and names stay
    apart; without it the whole text is cut at the limit.
    """
    head = F.concat(F.lit(fixed.JOB_PREFIX), kept_hint)
    whole = F.concat(head, F.lit("-"), F.lower(suffix))
    if not keep_suffix:
        return trim_name(whole)
    room = fixed.JOB_NAME_LIMIT - fixed.JOB_TOKEN_LENGTH - 1
    shortened = F.concat(trim_name(head, room), F.lit("-"), F.lower(suffix))
    return F.when(F.length(whole) <= fixed.JOB_NAME_LIMIT, trim_name(whole)).otherwise(shortened)


def short_head(kept_hint: Column) -> Column:
    """The part of a job name that two names with the same suffix and a number may share."""
    room = fixed.JOB_NAME_LIMIT - fixed.JOB_TOKEN_LENGTH - 1 - NUMBER_ROOM
    return trim_name(F.concat(F.lit(fixed.JOB_PREFIX), kept_hint), room)


def numbered_job_name(kept_hint: Column, suffix: Column, number: Column) -> Column:
    """The plain name for the first of a head and suffix, and a number behind it for each further one."""
    further = F.concat(short_head(kept_hint), F.lit("-"), F.lower(suffix), F.lit("-"), number.cast("string"))
    return F.when(number == 1, job_name(kept_hint, suffix)).otherwise(further)


def queue_name(pattern: Column, prefix: str) -> Column:
    return F.concat(F.lit(prefix), F.regexp_replace(pattern, _NOT_WORD, ""))


def platform(routing_key: Column) -> Column:
    """The platform word of an upload request key, NULL for any other key."""
    words = F.split(routing_key, r"\.")
    shape = fixed.UPLOAD_PATTERN.split(".")
    fits = [F.get(words, F.lit(i)) == w for i, w in enumerate(shape) if w != "*"]
    same_shape = reduce(lambda a, b: a & b, fits, F.size(words) == len(shape))
    return F.when(same_shape, F.get(words, F.lit(shape.index("*"))))
