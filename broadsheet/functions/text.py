"""Text normalisation, hashing and headline keys as native columns."""

from __future__ import annotations

import html
from functools import reduce
from operator import or_

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet import fixed_values as fv

# Every Unicode space, written so that Java and RE2 read it the same way.
SPACES = (
    r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
NOT_WORD = r"[^\p{L}\p{N}_]"


def let(value: Column, body) -> Column:
    """Evaluate `value` once and hand it to `body` as a lambda variable."""
    return F.transform(F.array(value), body)[0]


def bounded(alternatives: str) -> str:
    """Whole-word match with Unicode word borders; the same text works in Java and RE2."""
    return f"(?i)(^|{NOT_WORD})({alternatives})({NOT_WORD}|$)"


def begun(alternatives: str) -> str:
    """Looks ahead for the first two letters of any of the alternatives, so that most places of a text are passed over without
    trying each. Empty where one does not begin with two plain letters."""
    words = alternatives.split("|")
    if not all(w[:2].isalpha() and len(w) > 1 and w[2:3] not in ("?", "*", "{") for w in words):
        return ""
    firsts = {a: "".join(sorted({w[1] for w in words if w[0] == a})) for a in sorted({w[0] for w in words})}
    plain, other = ([a for a in firsts if a.isascii() == ascii_] for ascii_ in (True, False))
    # One set of ASCII letters or one range of others is a single test.
    tests = [f"[{''.join(plain)}]"] * bool(plain) + [f"[{other[0]}-{other[-1]}]" for _ in other[:1]]
    pairs = ["|".join(f"{a}[{firsts[a]}]" for a in some) for some in (plain, other) if some]
    return f"(?:{'|'.join(f'(?={test})(?={pair})' for test, pair in zip(tests, pairs))})"


def some_word(alternatives: str) -> str:
    """`bounded` for Java alone: the alternatives are only tried where one may begin."""
    return f"(^|{NOT_WORD}){begun(alternatives)}({alternatives})({NOT_WORD}|$)"


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive search that also folds non-ASCII letters."""
    return text.rlike("(?iu)" + pattern.removeprefix("(?i)"))


FOLDED = "\u0130\u0131\u017f\u212a"  # the letters beyond ASCII that a search without case takes for plain ones (i, s, k)


def holds_part(text: Column, lowered: Column, parts: tuple[str, ...]) -> Column:
    """Whether a case-insensitive search may find something in `text` of which one of `parts` (in lower case) is a piece;
    `lowered` is the text in lower case. Plain searches for a few parts cost far less than a pattern tried at every place."""
    return reduce(or_, [*(lowered.contains(p) for p in parts), *(text.contains(c) for c in FOLDED)])


@F.pandas_udf(T.StringType())
def _unescape(values: pd.Series) -> pd.Series:
    return values.map(html.unescape, na_action="ignore")


def unescape(text: Column, fence: bool = False) -> Column:
    """HTML entities; only rows holding an ampersand are handed to Python.

    With `fence` the result is not merged into later expressions, as unescaping it again needs.
    """
    decode = _unescape.asNondeterministic() if fence else _unescape
    return F.coalesce(decode(F.when(text.contains("&"), text)), text)


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACES, " "))


def drop_repeated_chunks(text: Column) -> Column:
    """Remove repeated 18-word chunks (sticky navigation, doubled cards); the first copy stays."""

    def rebuild(words: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(words), F.lit(fv.CHUNK_WORDS))
        chunks = F.transform(starts, lambda at: F.array_join(F.slice(words, at, fv.CHUNK_WORDS), " "))
        return F.when(F.size(words) > fv.CHUNK_WORDS, F.array_join(F.array_distinct(chunks), " ")).otherwise(
            F.array_join(words, " ")
        )

    return let(F.split(text, " "), rebuild)


def clean_text(text: Column, limit: int = fv.CLEAN_LIMIT, entities: bool = True, fence: bool = False) -> Column:
    plain = unescape(text, fence) if entities else text
    return F.trim(F.substring(drop_repeated_chunks(squeeze(plain)), 1, limit))


def clean_head(text: Column, size: int = fv.FINGERPRINT_CHARS, entities: bool = True) -> Column:
    """The first `size` characters of the clean text. The chunks that lie wholly in the beginning of the text decide, unless they
    repeat so much that they are too short; only then the whole text is cleaned."""
    reach = size + size // 2

    def of_chunks(words: Column) -> Column:
        whole = F.floor((F.size(words) - 1) / fv.CHUNK_WORDS).cast("int")  # the last word may be cut
        chunks = F.transform(F.sequence(F.lit(1), whole * fv.CHUNK_WORDS, F.lit(fv.CHUNK_WORDS)),
                             lambda at: F.array_join(F.slice(words, at, fv.CHUNK_WORDS), " "))
        return F.when(whole > 0, F.array_join(F.array_distinct(chunks), " "))

    def head(plain: Column) -> Column:
        begun_ = F.when(F.length(plain) > reach, let(F.split(squeeze(F.substring(plain, 1, reach)), " "), of_chunks))
        return let(begun_, lambda some: F.substring(F.coalesce(F.when(F.length(some) > size, some), clean_text(plain, entities=False)), 1, size))

    return let(unescape(text) if entities else text, head)


def fingerprint(title: Column, body: Column, entities: bool = True) -> Column:
    """Content key over the cleaned title and the first 1,500 cleaned body characters."""
    return fingerprint_of_clean(clean_text(title, entities=entities), clean_head(body, entities=entities))


def fingerprint_of_clean(title: Column, body: Column) -> Column:
    """The same key when both parts are already clean.

    Never NULL: a nullable join key would make Spark test the whole cleaning chain for NULL first,
    and so run it twice.
    """
    head = F.coalesce(F.lower(title), F.lit(""))
    start = F.coalesce(F.lower(F.substring(body, 1, fv.FINGERPRINT_CHARS)), F.lit(""))
    return F.coalesce(F.sha2(F.concat(head, F.lit("\n"), start), 256), F.lit(""))


def article_id(url: Column) -> Column:
    return F.sha2(url, 256)


def detect_language(text: Column) -> Column:
    han = F.length(F.regexp_replace(text, r"[^\x{4E00}-\x{9FFF}]", ""))
    latin = F.length(F.regexp_replace(text, "[^A-Za-z]", ""))
    return F.when((han >= 20) & (han * 5 >= latin), "zh").otherwise("en")


def version_set(title: Column) -> Column:
    """Sorted distinct major.minor versions named in a headline."""
    return F.array_sort(F.array_distinct(
        F.regexp_extract_all(F.lower(title), F.lit(r"(?U)\bv?(\d+\.\d+)(?:\.\d+)?\b"), 1)))


def title_key(title: Column) -> Column:
    """Casefolded headline without anything but letters, digits and underscore."""
    return F.coalesce(F.regexp_replace(F.replace(F.lower(title), F.lit("ß"), F.lit("ss")), NOT_WORD, ""), F.lit(""))


def release_series(title: Column) -> Column:
    """Patch releases of one minor version share a series."""
    return F.regexp_replace(F.lower(title), r"(v?\d+\.\d+)\.\d+", "$1")


def redact(text: Column) -> Column:
    for pattern, replacement in fv.SECRET_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return text


def redact_model_error(text: Column) -> Column:
    for pattern, replacement in fv.MODEL_ERROR_RULES:
        text = F.regexp_replace(text, pattern, replacement)
    return F.substring(text, 1, fv.MODEL_ERROR_LIMIT)
