"""Text functions as Column expressions: folding, slugs, outline markers, periods, provenance."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Blanks as Unicode sees them, at either end.
EDGE_BLANKS = r"(?U)^\s+|\s+$"


def _bases() -> tuple[str, str]:
    """Precomposed letters and the single letters they are built on, by rule, with the crossed d beside them."""
    pairs = {"đ": "d", "Đ": "D", "Ð": "D"}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        letter = chr(code)
        base = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
        if len(base) == 1 and base != letter:
            pairs[letter] = base
    return "".join(pairs), "".join(pairs.values())


ACCENTED, PLAIN = _bases()


def strip(text: Column) -> Column:
    return F.regexp_replace(text, EDGE_BLANKS, "")


def unaccent(text: Column) -> Column:
    """Letters without tone or other marks, composed or not."""
    return F.regexp_replace(F.translate(text, ACCENTED, PLAIN), r"\p{M}+", "")


def fold(text: Column) -> Column:
    """Lower-cased, without marks, crossed d as d; null as empty. NFC and NFD spellings fold alike."""
    return F.lower(unaccent(F.coalesce(text, F.lit(""))))


def slug(text: Column) -> Column:
    """ASCII letters and digits, everything else one underscore, none at the ends."""
    return F.regexp_replace(F.regexp_replace(unaccent(text), "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")


def flat(text: Column, limit: int | None = None) -> Column:
    """One line, whitespace collapsed; longer than limit: cut, with an ellipsis."""
    one = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)\s+", " "))
    return one if limit is None else F.when(F.char_length(one) > limit, F.concat(F.substring(one, 1, limit - 1), F.lit("…"))).otherwise(one)


def _sequences() -> list[tuple[str, str]]:
    """(spelling, letter) of every way to write an accented letter with separate marks, longest first: by rule, from canonical decompositions."""
    found = {}
    for letter in ACCENTED:
        parts = unicodedata.normalize("NFD", letter)
        if len(parts) > 1:
            for marks in {parts[1:], parts[1:][::-1]}:
                found[parts[0] + marks] = letter
                for i in range(1, len(marks)):
                    found[unicodedata.normalize("NFC", parts[0] + marks[:i]) + marks[i:]] = letter
    return sorted(((k, v) for k, v in found.items() if k != v and unicodedata.normalize("NFC", k) == v), key=lambda x: (-len(x[0]), x))


def composed(text: Column) -> Column:
    """A text with accented letters of the Latin script composed, wherever their marks stand apart. For other scripts see nfc()."""
    pairs = F.split(F.lit("\n".join(f"{k}\t{v}" for k, v in _sequences())), "\n")  # one literal, however often it's used
    joined = F.aggregate(pairs, text, lambda done, p: F.replace(done, F.substring_index(p, "\t", 1), F.substring_index(p, "\t", -1)))
    return F.when(text.rlike(r"\p{M}"), joined).otherwise(text)


def nfc(df: DataFrame, column: str) -> DataFrame:
    """df with a column composed. Spark has no such built-in: distinct values that hold marks are normalised in Arrow batches."""
    @F.pandas_udf("string")
    def compose(values):
        return values.map(lambda v: unicodedata.normalize("NFC", v), na_action="ignore")

    marked = df.filter(F.col(column).rlike(r"\p{M}")).select(F.col(column).alias("__raw")).distinct().withColumn("__nfc", compose("__raw"))
    return df.join(marked, F.col(column) == F.col("__raw"), "left").withColumn(column, F.coalesce("__nfc", column)).drop("__raw", "__nfc")


def ms_date(text: Column) -> Column:
    """/Date(milliseconds)/ as dd/MM/yyyy in UTC; blank where there is none."""
    ms = F.try_to_number(F.regexp_extract(F.coalesce(text, F.lit("")), r"/Date\((-?\d+)", 1), F.lit("S9999999999999999")).cast("long")
    day = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(ms / 86400000).cast("int"))
    return F.coalesce(F.date_format(day, "dd/MM/yyyy"), F.lit(""))


def period_year(label: Column) -> Column:
    return F.regexp_extract(F.coalesce(label, F.lit("")), r"((?:19|20)[0-9]{2})", 1).try_cast("int")


def period_kind(label: Column) -> Column:
    """Kind of a period label, in this order: year, six months, nine months, quarter, other. The words and the kinds' names."""
    low = F.lower(F.coalesce(label, F.lit("")))
    return (
        F.when(low.startswith("năm"), "Năm").when(low.contains("6 tháng"), "6 tháng").when(low.contains("9 tháng"), "9 tháng")
        .when(low.contains("quý"), "Quý").otherwise("Khác")
    )


#: Outline marks, each followed by a blank: dashes; numbers, dotted or in parentheses; romans; single letters.
ONE_MARK = r"(?:[-*+•]+|\(?[0-9]+(?:[.][0-9]+)*[.)]?|[IVXLC]{1,5}[.)]?|[A-Za-z][.)]?)\s+"


def indicator_clean(label: Column) -> Column:
    """A label without its leading outline marks. A label of marks alone keeps its last word."""
    s = strip(F.coalesce(label, F.lit("")))
    return F.regexp_replace(s, rf"^(?:{ONE_MARK})+", "")


def indicator_depth(label: Column) -> Column:
    s = strip(F.coalesce(label, F.lit("")))
    return F.size(F.regexp_extract_all(F.regexp_extract(s, rf"^((?:{ONE_MARK})*)", 1), F.lit(f"({ONE_MARK})"), F.lit(1)))


#: The spellings of a mark in front of a label.
MARKER = (
    r"^\s*("
    + "|".join((
        r"\(\s*[0-9]+\s*\)[.)]?",  # (1)
        r"[-*+•]+",  # dash or bullet
        r"[0-9]+(?:\.[0-9]+)*[.)]?",  # 1 or 1.1
        r"[IVXLC]+\.[0-9]+(?:\.[0-9]+)*[.)]?",  # I.1
        r"[A-ZĐ]\.[0-9]+(?:\.[0-9]+)*[.)]?",  # A.2
        r"[IVXLC]{2,}[.)]?",  # II
        r"[IVXLCĐA-Za-z][.)]?",  # a letter
    ))
    + r")\s"
)


def outline_marker(label: Column) -> Column:
    """The mark before a label, empty for none."""
    return F.regexp_extract(F.coalesce(label, F.lit("")), MARKER, 1)


#: Levels of marks: ordered, with room for dotted ones between.
SECTION, ROMAN, PAREN, ARABIC, LOWER, DASH = 0, 2, 4, 6, 10, 12
#: Letters that as marks are never roman digits.
LETTERS = "ABĐEGHKNOPQRSTUYCDLM"


def bare_marker(label: Column) -> Column:
    return F.trim(F.regexp_replace(outline_marker(label), r"[.)]+$", ""))


def outline_level(label: Column, lettered: bool = False) -> Column:
    """Level of a label's mark, null for none. A bare I is a section where `lettered`, else roman."""
    mark, bare = outline_marker(label), bare_marker(label)
    dots = F.char_length(bare) - F.char_length(F.replace(bare, F.lit("."), F.lit("")))
    return (
        F.when(mark == "", F.lit(None).cast("int"))
        .when(mark.rlike(r"^[-*+•]"), DASH)
        .when(bare.startswith("("), PAREN)
        .when(bare.rlike(r"^[0-9.]+$"), ARABIC + dots)
        .when(bare.rlike(r"^[IVXLC]+\."), ROMAN + dots)
        .when(bare.rlike(r"^[A-ZĐ]\."), SECTION + dots)
        .when(bare.rlike(r"^[IVXLC]{2,}$"), ROMAN)
        .when(bare.rlike(f"^[{LETTERS}]$"), SECTION)
        .when(bare == "I", SECTION if lettered else ROMAN)
        .when(bare.isin("V", "X"), ROMAN)
        .when(bare.rlike("^[A-ZĐ]+$"), SECTION)
        .otherwise(LOWER)
    )


def form_code(table_label: Column) -> Column:
    """The code in brackets that ends a table's label."""
    return F.regexp_extract(F.coalesce(table_label, F.lit("")), r"\[([^\]]*)\]\s*$", 1)


def note_report(note: Column) -> Column:
    return F.coalesce(F.regexp_extract(F.coalesce(note, F.lit("")), r"report (\d+)", 1).try_cast("int"), F.lit(0))


def note_unit(note: Column, unit: Column) -> Column:
    """The published unit that a note tells of, else the unit."""
    return F.coalesce(F.nullif(strip(F.regexp_extract(F.coalesce(note, F.lit("")), r"ĐVT nguồn:\s*([^;]+)", 1)), F.lit("")), unit)


def blank_coalesce(*columns: Column) -> Column:
    """The first that is neither null nor blank, else an empty text."""
    return F.coalesce(*[F.nullif(strip(c), F.lit("")) for c in columns], F.lit(""))


#: Parts of words, folded, that ask for settled figures or for the plan.
SETTLED = ("quyet toan", "quyettoan", "settled", "outturn", "actual", "final")
PLANNED = ("du toan", "dutoan", "plan", "budget", "estimate")
#: Terms of series labels and what they mean.
GLOSSARY = {
    "QUYẾT TOÁN": "settled accounts (the outturn)", "DỰ TOÁN": "the plan, not what was spent", "TỔNG THU NSNN": "all state revenue collected in the province",
    "THU NSĐP": "only the share the province keeps - a subset of TỔNG THU NSNN", "NGÂN SÁCH CẤP TỈNH": "the provincial tier only", "NGÂN SÁCH HUYỆN": "the district tier only",
    "SO SÁNH": "a percentage comparison column, not money", "ƯỚC THỰC HIỆN": "an in-year estimate, not final", "TỔNG SỐ": "the combined total of the tiers beside it",
}


def basis(text: Column) -> Column:
    """True for settled figures, false for plans, by the words that a text contains; anything else is an error."""
    low = fold(text)
    has = lambda words: reduce(lambda a, b: a | b, [low.contains(w) for w in words])
    return F.when(has(SETTLED), True).when(has(PLANNED), False).otherwise(F.raise_error(F.concat(F.lit("unknown basis: "), F.coalesce(text, F.lit("null")))).cast("boolean"))


def is_settled(word: str) -> bool:
    """basis() of one word that a caller gives as a parameter."""
    low = "".join(c for c in unicodedata.normalize("NFD", word.lower()) if not unicodedata.combining(c)).replace("đ", "d")
    for words, settled in ((SETTLED, True), (PLANNED, False)):
        if any(w in low for w in words):
            return settled
    raise ValueError(f"unknown basis: {word}")


def glossary(shown: DataFrame, label: str = "series", terms: dict[str, str] = GLOSSARY) -> DataFrame:
    """(term, meaning) of the terms that the labels of shown contain, in any case."""
    known = shown.sparkSession.createDataFrame(list(terms.items()), "term string, meaning string")
    labels = shown.select(F.upper(label).alias("__label")).distinct()
    # A few terms, and so the side to broadcast; labels stay where they are.
    return labels.join(F.broadcast(known), F.col("__label").contains(F.col("term"))).select("term", "meaning").distinct()


def clamp(number: Column, low: int, high: int, default: int) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), F.coalesce(number.try_cast("int"), F.lit(default))))
