"""Text rules as column expressions. All stay inside the JVM.

White space and letters are spelled out, as \\s and \\w in Java's expressions cover other characters than Unicode's
White_Space and Letter sets do.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, as letters, as invisible, as control characters.
WS = r"[\x09-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
WS_CHARACTERS = "\t\n\x0b\f\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
BLANK = r"[\x09\x0b-\x0d\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LETTER = r"[\p{L}\p{Nl}\p{No}]"
INVISIBLE = r"[\xad\u200b-\u200f\u202a-\u202e\u2060-\u2064\u206a-\u206f\ufeff]"
CONTROL = r"[\x00-\x08\x0b\x0e-\x1f\x7f-\x9f\ufffd\ue000-\uf8ff]"
PLAUSIBLE = rf"(?<![\p{{L}}\p{{N}}_]){LETTER}{{3,20}}(?![\p{{L}}\p{{N}}_])"

TABULAR = ("csv", "xlsx", "pbf")
WORDS_PER_PAGE, EVERY_PAGES, MIN_REPEATS = 400.0, 2, 5


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once for each row. An expression named inside a lambda function is computed anew
    for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words(text: Column) -> Column:
    """Spaces are found by comparison, other white space by a look into a table: classes of many ranges cost more than the rest."""
    return F.array_remove(F.split(F.translate(text, WS_CHARACTERS, " " * len(WS_CHARACTERS)), " "), "")


def word_count(text: Column) -> Column:
    return F.size(words(text))


def text_key(text: Column) -> Column:
    """Equal for texts that differ in white space only."""
    return F.array_join(words(text), " ")


def plausible_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(PLAUSIBLE))


def line_breaks(text: Column) -> Column:
    """One kind of line end; form feeds and paragraph separators become paragraphs. (The NFC step is in pytext.)"""
    out = F.regexp_replace(text, r"\r\n?|\u2028|\x0b", "\n")
    return F.regexp_replace(out, r"\u2029|\f", "\n\n")


def strip_control(text: Column) -> Column:
    """Invisible characters go. A control character goes or becomes a space, whichever gives more plausible words."""
    seen = F.regexp_replace(text, INVISIBLE, "")
    deleted, spaced = F.regexp_replace(seen, CONTROL, ""), F.regexp_replace(seen, CONTROL, " ")
    return F.when(~seen.rlike(CONTROL), seen).when(plausible_words(spaced) > plausible_words(deleted), spaced).otherwise(deleted)


def dehyphenate(text: Column) -> Column:
    """A word broken by a hyphen at a line's end is joined if it goes on in lower case."""
    return F.regexp_replace(text, rf"({LETTER})-[ \t]*\n[ \t]*(\p{{Ll}})|({LETTER}-[ \t]*\n[ \t]*{LETTER})", "$1$2$3")


def strip_spaced_letters(text: Column) -> Column:
    """Ten or more single letters with blanks between them become one space."""
    return F.regexp_replace(text, rf"(?U)(?:\b{LETTER}\b[ \t]+){{10,}}(?:\b{LETTER}\b)?", " ")


def strip_anonymous_columns(text: Column) -> Column:
    """Lines of a column without a name that hold only a number go."""
    return F.regexp_replace(text, r"(?m)^columna_\d+: -?\d+(?:\.\d+)?[ \t]*$\n?", "")


def collapse_whitespace(text: Column, tabular: bool = False) -> Column:
    out = F.regexp_replace(text, f"{BLANK}+", " ")
    out = F.regexp_replace(out, " ?\n ?", "\n")
    if not tabular:
        out = F.regexp_replace(out, r"(?<!\n)\n(?!\n)", " ")
        out = F.regexp_replace(out, " {2,}", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return F.regexp_replace(out, rf"^{WS}+|{WS}+\z", "")


def repeat_threshold(n_words: Column) -> Column:
    """How often a run of words must occur to be page furniture: once every two pages, five times at least."""
    pages = F.greatest(F.lit(1.0), n_words / WORDS_PER_PAGE)
    return F.greatest(F.lit(MIN_REPEATS), F.ceil(pages / EVERY_PAGES)).cast("int")


def paragraph_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, rf"\n{WS}*\n"), lambda p: p.rlike(rf"[^{WS[1:-1]}]")))


def counted_slices(text: Column, limit: int = 250) -> Column:
    """A text in slices of ``limit`` words, each with its number of words: structs (text, n_words)."""

    def sliced(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0)), F.lit(limit))
        one = lambda i: F.struct(F.array_join(F.slice(w, i + 1, limit), " ").alias("text"), F.least(F.size(w) - i, F.lit(limit)).alias("n_words"))
        return F.when(F.size(w) > 0, F.transform(starts, one)).otherwise(F.array())

    return once(words(text), sliced)


def hard_slices(text: Column, limit: int = 250) -> Column:
    return counted_slices(text, limit)["text"]


def snake_case(name: Column) -> Column:
    return F.lower(F.regexp_replace(name, "(?<!^)(?=[A-Z])", "_"))


def is_acronym(form: Column) -> Column:
    return form.rlike(LETTER) & (form == F.upper(form))


def heads(key: Column, skip: tuple[str, ...]) -> Column:
    """First letters of the words of a name's key that aren't in ``skip``, in one word; null for fewer than two."""
    counted = F.filter(F.split(key, " "), lambda w: ~w.isin(*skip) & (w != ""))
    return F.when(F.size(counted) > 1, F.array_join(F.transform(counted, lambda w: F.substring(w, 1, 1)), ""))


def may_be_acronym(key: Column) -> Column:
    return key.rlike(r"^\p{L}{2,8}$")


def is_plural_of(a: Column, b: Column) -> Column:
    """By regular endings only; the singular has four letters at least."""
    ends = (a == F.concat(b, F.lit("s"))) | (a == F.concat(b, F.lit("es")))
    ends |= b.endswith("z") & (a == F.concat(F.substring(b, F.lit(1), F.length(b) - 1), F.lit("ces")))
    ends |= b.endswith("y") & (a == F.concat(F.substring(b, F.lit(1), F.length(b) - 1), F.lit("ies")))
    return (F.length(b) >= 4) & (F.length(a) > F.length(b)) & ends


def topic_of_query(query_id: Column) -> Column:
    """Queries 1 to 16, 17 to 32 and 33 to 50 belong to topics 1, 2 and 3."""
    n = F.regexp_extract(query_id, r"(\d+)", 1).try_cast("int")
    return F.when(n.between(1, 16), 1).when(n.between(17, 32), 2).when(n.between(33, 50), 3)


def topic_of_document(doc_id: Column) -> Column:
    return F.regexp_extract(doc_id, r"^F(\d)-", 1).try_cast("int")


def stable_draw(key: Column, divisor: int) -> Column:
    """Whether md5(key), as a number of 128 bits, is divisible: by Horner's rule over its eight 16-bit digits."""
    digest = F.md5(key)
    digit = lambda i: F.conv(F.substring(digest, 4 * i + 1, 4), 16, 10).cast("bigint")
    rest = F.lit(0).cast("bigint")
    for i in range(8):
        rest = (rest * 65536 + digit(i)) % divisor
    return rest == 0


def ner_tokens(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"(?U)\w+(?:[-_]\w+)*|[^\s]"))


def readable_share(text: Column) -> Column:
    """Of the words, how many are plausible; below one half it's noise."""
    return F.coalesce(plausible_words(text) / F.nullif(word_count(text), F.lit(0)), F.lit(0.0))


def cell_text(value: Column, kind: str) -> Column:
    """A table cell as text: whole floats without a decimal point, times in ISO form, null as nothing."""
    if kind in ("double", "float"):
        shown = F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    elif kind.startswith("timestamp"):
        shown = F.date_format(value, "yyyy-MM-dd'T'HH:mm:ss")
    else:
        shown = F.trim(value.cast("string"))
    return F.coalesce(shown, F.lit(""))


def record_block(columns: dict[str, str], skip: tuple[str, ...] = ()) -> Column:
    """A row as lines "name: value"; empty cells are left out. columns: name -> type."""
    cells = [F.struct(F.lit(n).alias("k"), cell_text(F.col(n), t).alias("v")) for n, t in columns.items() if n not in skip]
    return F.array_join(F.transform(F.filter(F.array(*cells), lambda c: c["v"] != ""), lambda c: F.concat(c["k"], F.lit(": "), c["v"])), "\n")


def normal_path(path: Column) -> Column:
    return F.regexp_replace(F.replace(F.trim(path), F.lit("\\"), F.lit("/")), r"^\./", "")
