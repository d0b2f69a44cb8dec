"""Text columns: normal forms, search forms, entities, and cleaning of answers."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T
from pyspark.sql.functions import pandas_udf, udtf

TONES = ["", "̀", "́", "̉", "̃", "̣"]


def _letters() -> dict[str, str]:
    """Every Vietnamese letter that is not plain, and the plain letter under it: vowels by tone, and d with stroke."""
    table = {"đ": "d"}
    for plain, vowels in {"a": "aăâ", "e": "eê", "i": "i", "o": "oôơ", "u": "uư", "y": "y"}.items():
        for v in vowels:
            table |= {unicodedata.normalize("NFC", v + t): plain for t in TONES if v + t != plain}
    return table | {k.upper(): v.upper() for k, v in table.items()}


PLAIN_LETTER = _letters()
MARKED, PLAIN = "".join(PLAIN_LETTER), "".join(PLAIN_LETTER.values())
LOWER_MARKED = "".join(c for c in PLAIN_LETTER if c.islower())

#: Words of questions that carry no content.
STOPWORDS = ["tim", "video", "canh", "hinh", "anh", "co", "bao", "nhieu", "o", "dau", "mau", "gi", "la", "ai", "nao", "trong", "khoang", "thoi", "gian", "dia", "diem", "xem", "cho", "biet", "ten", "the", "do", "va", "voi", "mot", "nhung", "cac"]

#: Entity patterns in the order in which entities are listed; the flag tells whether case matters.
ENTITY_PATTERNS = {
    "PRICE": (r"\b(\d+(?:[.,]\d+)?\s*(?:k|vnđ|vnd|đ|nghìn|ngàn|triệu|tr))\b", False),
    "LICENSE_PLATE": (r"\b([0-9]{2}[-\s]?[A-Z]{1,2}[0-9]?[-\s]?[0-9]{3,5}(?:\.[0-9]{2})?)\b", False),
    "PHONE_NUMBER": (r"\b((?:0|\+84)[235789][0-9]{8})\b", True),
    "TIME": (r"\b([0-2]?[0-9][h:][0-5][0-9](?::[0-5][0-9])?)\b", False),
    "NUMBER": (r"\b(\d+(?:\.\d+)?)\b", True),
}
ENTITY = T.StructType([T.StructField("type", T.StringType()), T.StructField("value", T.StringType()), T.StructField("span", T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))])


#: The white space of Unicode.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    """Without white space at either end, as Unicode defines it; null is empty."""
    return F.btrim(F.coalesce(c, F.lit("")), F.lit(WHITE))


@pandas_udf(T.StringType())
def nfc(texts: pd.Series) -> pd.Series:
    """Unicode normal form C (Spark has no built-in)."""
    return texts.str.normalize("NFC")


#: A character that may change, or be changed by its neighbours, in normal form C. Those up to U+02FF, the Vietnamese letters from U+1EA0 and punctuation
#: and currencies from U+2002 never do, so texts of them alone are in normal form.
UNSETTLED = r"[^\x00-\u02ff\u1ea0-\u1ef9\u2002-\u20cf]"


def normalize_nfc(c: Column) -> Column:
    """Only texts that may not be in normal form are sent to Python. A condition around the function would not keep the others from it, its argument does."""
    s = strip(c)
    return F.coalesce(nfc(F.when((F.octet_length(c) != F.char_length(c)) & c.rlike(UNSETTLED), s)), s)


def clean_text(c: Column) -> Column:
    """NFC, control characters deleted, white space collapsed, ends stripped; in this order."""
    bare = F.regexp_replace(normalize_nfc(c), "[\\x00-\\x1f\\x7f-\\x9f]", "")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def plain_letters(c: Column) -> Column:
    return F.translate(c, MARKED, PLAIN)


def to_unsigned(c: Column) -> Column:
    """Search form without Vietnamese marks, in lower case. Other accents stay."""
    return strip(F.lower(plain_letters(normalize_nfc(c))))


def unsigned_of_clean(c: Column) -> Column:
    """to_unsigned of a text that clean_text has made; needs no Python."""
    return strip(F.lower(plain_letters(c)))


def diacritics(c: Column) -> Column:
    """How many Vietnamese letters with marks a text has."""
    return F.length(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), f"[^{LOWER_MARKED}]", ""))


def is_vietnamese(c: Column) -> Column:
    return diacritics(c) > 0


def query_tokens(unsigned: Column) -> Column:
    """Content words of a query in search form; all words if none is left. Repeats stay."""
    words = F.filter(F.split(strip(unsigned), r"(?U)\s+"), lambda w: w != "")
    content = F.filter(words, lambda w: ~w.isin(STOPWORDS))
    return F.when(F.size(content) > 0, content).otherwise(words)


#: A letter, digit or underscore, and the edge of a run of them. Java's own \b counts combining marks in, Python's does not.
#: Java looks behind by 16-bit units: {1,2} lets it find one character of two of them.
WORD = r"[\p{L}\p{N}_]"
EDGE = f"(?:(?<!{WORD}{{1,2}})(?={WORD})|(?<={WORD}{{1,2}})(?!{WORD}))"
BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body names it inside other lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def running_sums(lengths: Column) -> Column:
    """The sum of each int and all before it. Folds copy what they append to, so blocks are summed first, then summed up inside."""

    def sums(a: Column, start: Column) -> Column:
        zero = F.struct(start.alias("t"), F.array().cast("array<int>").alias("r"))
        return F.aggregate(a, zero, lambda s, x: F.struct((s["t"] + x).alias("t"), F.concat(s["r"], F.array(s["t"] + x)).alias("r")), lambda s: s["r"])

    def blocks(a: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), ((F.size(a) - 1) / BLOCK).cast("int")), lambda b: F.slice(a, b * BLOCK + 1, F.lit(BLOCK)))

    def joined(parts: Column) -> Column:
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda s, x: s + x))
        return F.flatten(let(sums(totals, F.lit(0)), lambda ends: F.transform(parts, lambda p, i: sums(p, F.coalesce(F.get(ends, i - 1), F.lit(0))))))

    return let(lengths, lambda a: F.when(F.size(a) > 0, let(blocks(a), joined)).otherwise(F.array().cast("array<int>")))


def _pattern(kind: str) -> Column:
    pattern, cased = ENTITY_PATTERNS[kind]
    # all entities begin with a digit or +, which is looked for first
    return F.lit(("(?U)" if cased else "(?iuU)") + r"(?=[\d+])" + pattern.replace(r"\b", EDGE))


def _where_digits(c: Column, of: Callable[[str, Column], Column], kind: str) -> Column:
    """Entities of all types, listed by type; a text without a digit, also a null, has none."""
    return let(F.coalesce(c, F.lit("")), lambda s: F.when(s.rlike(r"\p{Nd}"), F.concat(*[of(k, s) for k in ENTITY_PATTERNS])).otherwise(F.array().cast(kind)))


def entity_values(c: Column) -> Column:
    """array<struct<type, value>> of all entities."""

    def of(kind: str, s: Column) -> Column:
        return F.transform(F.regexp_extract_all(s, _pattern(kind), F.lit(1)), lambda v: F.struct(F.lit(kind).alias("type"), (F.upper(v) if kind == "LICENSE_PLATE" else v).alias("value")))

    return _where_digits(c, of, "array<struct<type: string, value: string>>")


def extract_entities(c: Column) -> Column:
    """array<struct<type, value, span>>: entities with the span of each in characters, by built-in functions alone.

    Texts between entities and entities alternate, so a start is the sum of all lengths before it.
    """

    def of(kind: str, s: Column) -> Column:
        def spans(values: Column) -> Column:
            steps = F.transform(F.slice(F.split(s, _pattern(kind), -1), F.lit(1), F.size(values)), lambda p, i: F.char_length(p) + F.coalesce(F.char_length(F.get(values, i - 1)), F.lit(0)))
            return F.zip_with(values, running_sums(steps), lambda v, at: F.struct(F.lit(kind).alias("type"), (F.upper(v) if kind == "LICENSE_PLATE" else v).alias("value"), F.struct(at.alias("start"), (at + F.char_length(v)).alias("end")).alias("span")))

        return let(F.regexp_extract_all(s, _pattern(kind), F.lit(1)), spans)

    return _where_digits(c, of, f"array<{ENTITY.simpleString()}>")


_COMPILED = {k: re.compile(p, 0 if cased else re.IGNORECASE) for k, (p, cased) in ENTITY_PATTERNS.items()}


def plain_entities(text: str | None) -> Iterator[tuple]:
    """pos, type, value, start, end of the entities of one text, by Python's re."""
    pos = 0
    for kind, pattern in _COMPILED.items():
        for m in pattern.finditer(text or ""):
            yield pos, kind, m.group(1).upper() if kind == "LICENSE_PLATE" else m.group(1), m.start(), m.end()
            pos += 1


@udtf(returnType="pos: int, type: string, value: string, start: int, `end`: int")
class TextEntities:
    """Entities of one text as rows, for LATERAL joins in SQL."""

    def eval(self, text: str):
        yield from plain_entities(text)


def similarity(a: str | None, b: str | None) -> float:
    """Ratcliff-Obershelp ratio of two texts, case and outer white space aside; 0 if either is empty."""
    if not a or not b:
        return 0.0
    a, b = a.strip().lower(), b.strip().lower()
    return 1.0 if a == b else SequenceMatcher(None, a, b).ratio()


@functools.lru_cache(maxsize=1 << 14)
def _letters_of(text: str) -> tuple[str, Counter]:
    folded = text.strip().lower()
    return folded, Counter(folded)


def common_letters(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of a at once as bits of a number."""
    codes = np.frombuffer(a.encode("utf-32-le", "surrogatepass"), "<u4")
    places = {c: int.from_bytes(np.packbits(codes == ord(c), bitorder="little").tobytes(), "little") for c in set(a) & set(b)}
    whole = free = (1 << len(a)) - 1
    for c in b:
        if c in places:
            met = free & places[c]
            free = ((free + met) | (free - met)) & whole
    return len(a) - free.bit_count()


def similar(a: str | None, b: str | None, threshold: float) -> bool:
    """similarity(a, b) >= threshold. The ratio counts letters of a common subsequence, so lengths, letters in any order and the
    longest common subsequence bound it, each dearer than the one before; few texts are compared beyond them."""
    if not a or not b:
        return threshold <= 0.0
    (a, in_a), (b, in_b) = _letters_of(a), _letters_of(b)
    if a == b:
        return threshold <= 1.0
    total = len(a) + len(b)
    if 2.0 * min(len(a), len(b)) / total < threshold or 2.0 * sum(min(n, in_b[c]) for c, n in in_a.items()) / total < threshold:
        return False
    if 2.0 * common_letters(a, b) / total < threshold:
        return False
    return SequenceMatcher(None, a, b).ratio() >= threshold


@pandas_udf(T.DoubleType())
def text_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


def clean_video_id(c: Column) -> Column:
    return F.regexp_replace(strip(c), r"(?i)\.mp4$", "")


def clean_frame_idx(c: Column) -> Column:
    """Digits with white space in between as a number; 0 if it is none."""
    return F.coalesce(F.regexp_replace(c.cast("string"), r"(?U)\s+", "").try_cast("bigint"), F.lit(0).cast("bigint"))


def clean_answer(c: Column, most: int = 100) -> Column:
    return F.regexp_replace(F.substring(strip(c), 1, most), r"(?U)\s+$", "")


def register(spark) -> None:
    """Functions for SQL: vn_nfc, text_ratio; the table function text_entities; vn_clean, vn_strip, vn_normal, vn_plain, vn_unsigned and vn_marks, which are SQL themselves
    (only texts that may not be in normal form go to Python). They last as long as the session."""
    for name, f in {"vn_nfc": nfc, "text_ratio": text_similarity}.items():
        spark.udf.register(name, f)
    spark.udtf.register("text_entities", TextEntities)
    white = f"'{''.join(f'{chr(92)}u{ord(c):04x}' for c in WHITE)}'"
    bodies = {
        "vn_strip": f"btrim(coalesce(s, ''), {white})",
        "vn_normal": f"coalesce(vn_nfc(CASE WHEN octet_length(s) <> char_length(s) AND s RLIKE '{UNSETTLED.replace(chr(92), 2 * chr(92))}' THEN vn_strip(s) END), vn_strip(s))",
        "vn_clean": r"vn_strip(regexp_replace(regexp_replace(coalesce(vn_normal(s), ''), '[\\x00-\\x1f\\x7f-\\x9f]', ''), '(?U)\\s+', ' '))",
        "vn_plain": f"translate(s, '{MARKED}', '{PLAIN}')",
        "vn_unsigned": "vn_strip(lower(vn_plain(coalesce(vn_normal(s), ''))))",
    }
    for name, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(s STRING) RETURNS STRING RETURN {body}")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION vn_marks(s STRING) RETURNS INT RETURN char_length(regexp_replace(lower(coalesce(s, '')), '[^{LOWER_MARKED}]', ''))")
