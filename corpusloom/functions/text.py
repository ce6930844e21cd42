"""String functions on columns that keep the semantics of the collector's own language where they differ from Spark's."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What counts as white space when a text is trimmed (Unicode spaces, line terminators and the byte order mark).
TRIMMED = "\t\n\v\f\r \u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

#: Fixed values of the message sink.
MESSAGE_LIMIT = 4000
MESSAGE_SUFFIX = "\n\n⚠️ [Message truncated]"
MESSAGE_GAP = "\n\n..."


def full_trim(c: Column) -> Column:
    """Trim every kind of white space; Spark's own trim removes spaces only."""
    return F.trim(c, F.lit(TRIMMED))


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def unify_line_ends(c: Column) -> Column:
    """U+2028 and U+2029 become line feeds."""
    return F.translate(c, "\u2028\u2029", "\n\n")


def percentage(part: Column, whole: Column) -> Column:
    """Floored to one decimal, without a trailing '.0'; '0%' of nothing."""
    share = F.floor(part.cast("double") / whole * 1000) / 10
    return F.when(whole > 0, F.concat(F.call_function("format_number", share, F.lit("0.#")), F.lit("%"))).otherwise(F.lit("0%"))


def embedding_text(title: Column, content: Column) -> Column:
    """Title, a blank line and the content; the content alone where the title is missing."""
    return F.when(none_if_empty(title).isNotNull(), F.concat(title, F.lit("\n\n"), content)).otherwise(content)


def shorten_message(message: str, limit: int = MESSAGE_LIMIT) -> str:
    """``truncate_message`` for one text on the driver."""
    room = limit - len(MESSAGE_SUFFIX)
    head = room * 8 // 10
    return message if len(message) <= limit else message[:head] + MESSAGE_SUFFIX + MESSAGE_GAP + message[head - room :]


def truncate_message(c: Column, limit: int = MESSAGE_LIMIT) -> Column:
    """A message beyond the limit keeps four fifths of the room from its head and the rest from its tail."""
    room = limit - len(MESSAGE_SUFFIX)
    head = room * 8 // 10
    return F.when(F.length(c) <= limit, c).otherwise(F.concat(F.substring(c, 1, head), F.lit(MESSAGE_SUFFIX + MESSAGE_GAP), F.right(c, F.lit(room - head))))


def change_description(old_title: Column, new_title: Column, old_content: Column, new_content: Column) -> Column:
    """What differs, as text; NULL where nothing does."""
    shown = lambda c: F.coalesce(c, F.lit("null"))
    title = F.when(~old_title.eqNullSafe(new_title), F.concat(F.lit('Title: "'), shown(old_title), F.lit('" → "'), shown(new_title), F.lit('"')))
    size = lambda c: F.coalesce(F.length(c), F.lit(0)).cast("string")
    content = F.when(~old_content.eqNullSafe(new_content), F.concat(F.lit("Content: "), size(old_content), F.lit(" → "), size(new_content), F.lit(" chars")))
    return none_if_empty(F.concat_ws(", ", title, content))


def excerpt(title: Column, content: Column, size: int = 200) -> Column:
    return F.concat(F.lit("Title: "), F.coalesce(title, F.lit("null")), F.lit("\nContent: "), F.substring(F.coalesce(content, F.lit("")), 1, size), F.lit("..."))
