"""Numbers and units of money as Column expressions. Nothing is guessed: what isn't listed stays without a figure."""

from __future__ import annotations

from decimal import Decimal
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.text import composed, strip

#: Spellings of the currency, of its scales, and of percent.
CURRENCY = ("đồng", "dồng", "đổng", "vnd")
SCALE = {"đồng": 1, "dồng": 1, "đổng": 1, "nghìn": 1_000, "ngàn": 1_000, "triệu": 1_000_000, "tiệu": 1_000_000, "tr": 1_000_000, "tỷ": 1_000_000_000, "tỉ": 1_000_000_000}
POWERS = (1, 1_000, 1_000_000, 1_000_000_000)
PERCENT = ("%", "% (phần trăm)", "%(phần trăm)", "phần trăm (%)", "phần trăm", "(%)", "% (phan tram)", "percent", "%.")
IMPLAUSIBLE = 10**15


def norm_num(raw: Column) -> Column:
    """A published number as double; null for blanks, dashes and anything but digits, dots, commas and spaces.

    With both marks the dots group and the comma is decimal. A single comma is decimal between parts of three
    digits at most; other commas group. Dots alone are read as they are.
    """
    s = strip(F.coalesce(raw, F.lit("")))
    tight = F.replace(s, F.lit(" "), F.lit(""))
    comma, dot = tight.contains(","), tight.contains(".")
    decimal = F.replace(tight, F.lit(","), F.lit("."))
    number = (
        F.when(comma & dot, F.replace(F.replace(tight, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))
        .when(comma & tight.rlike(r"^[^,]{0,3},[^,]{0,3}$"), decimal)
        .when(comma, F.replace(tight, F.lit(","), F.lit("")))
        .otherwise(tight)
    )
    return F.when(s.rlike(r"^-?[0-9., ]+$"), number.try_cast("double"))


def _let(value: Column, body) -> Column:
    """body(value) with value computed once: an expression used several times would grow without end."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _drop_stray(u: Column) -> Column:
    """Closing parentheses at the end go, with what stands between them, if there are more of them than open ones: then none is left at the end."""
    stray = u.endswith(")") & (F.regexp_count(u, F.lit(r"\(")) < F.regexp_count(u, F.lit(r"\)")))
    return F.when(stray, strip(F.regexp_replace(F.regexp_replace(u, r"\)$", ""), r"[\s.:;,/\])]+$", ""))).otherwise(u)


def clean_unit(unit: Column) -> Column:
    """A unit without decoration, its letters composed, in one spelling of whitespace."""
    u = strip(_let(F.coalesce(unit, F.lit("")), composed))
    u = F.regexp_replace(F.regexp_replace(u, r"^[\s\[]+", ""), r"[\s.:;,/\]]+$", "")
    u = _let(u, _drop_stray)
    return F.trim(F.regexp_replace(u, r"(?U)\s+", " "))


def _factor(words: Column) -> Column:
    last, before = F.element_at(words, -1), F.try_element_at(words, F.lit(-2))
    scales = F.create_map(*[F.lit(x) for x in chain.from_iterable(SCALE.items())])
    digits = F.translate(before, ".,", "").try_cast("long")
    named = F.coalesce(F.try_element_at(scales, before), F.when(before.rlike(r"^[0-9.,]+$") & digits.isin(*POWERS), digits)).cast("long")
    return (
        F.when(F.array_join(words, " ").contains("%") | ~last.isin(*CURRENCY), F.lit(None).cast("long"))
        .when(F.size(words) == 1, F.lit(1).cast("long"))
        .when(last == "vnd", F.lit(None).cast("long"))
        .otherwise(named)
    )


def unit_factor(unit: Column) -> Column:
    """Multiplier to single units of the currency, by words; null where unknown or ambiguous."""
    return _let(F.split(F.lower(clean_unit(unit)), " "), _factor)


def canon_unit(unit: Column) -> Column:
    """VND for a known currency, % for the listed spellings of percent, else the unit, cleaned."""
    def named(u: Column) -> Column:
        return F.when(_factor(F.split(F.lower(u), " ")).isNotNull(), "VND").when(F.lower(u).isin(*PERCENT), "%").otherwise(u)

    return _let(clean_unit(unit), named)


def to_vnd(raw: Column, unit: Column) -> Column:
    """struct(value, unit, vnd, unit_note): a number times its factor where there is one; vnd only with both."""
    n, factor = norm_num(raw), unit_factor(unit)
    value = F.when(factor.isNotNull(), n * factor).otherwise(n)
    canon = canon_unit(unit)
    note = F.when(clean_unit(unit) != canon, F.concat(F.lit("ĐVT nguồn: "), clean_unit(unit))).otherwise("")
    return F.struct(value.alias("value"), canon.alias("unit"), F.when(factor.isNotNull(), n * factor).alias("vnd"), note.alias("unit_note"))


#: Fixed value: words of agencies, which the same label can introduce.
AGENCY = r"(?i)(ubnd|ủy ban|uỷ ban|^sở\s|^ban\s|trung tâm|^trạm\s|chi cục|^phòng\s|văn phòng|bệnh viện|^trường\s|công ty|^đội\s|^hạt\s|^vườn\s)"


def looks_like_unit(text: Column) -> Column:
    """Whether a text after "Đơn vị:" is a unit of measure rather than an agency."""
    t = F.coalesce(text, F.lit(""))
    known = unit_factor(t).isNotNull() | t.contains("%")
    return (t != "") & ~F.lower(t).rlike(AGENCY) & (known | ((F.char_length(t) <= 16) & ~t.rlike("[0-9]{3}")))


def money(vnd: Column) -> Column:
    """Billions as text with at most three decimals; a figure other than 0 never reads 0; null is blank."""
    d = vnd.cast("decimal(28,0)")
    def shown(places: int) -> Column:
        text = F.round(d.cast("decimal(38,9)") / F.lit(1_000_000_000), places).cast(f"decimal(38,{places})").cast("string")
        return F.regexp_replace(text, r"\.?0+$", "")

    three = shown(3)
    text = F.when(three.isin("", "0", "-0", "-") & (d != 0), F.regexp_replace(shown(9), r"^\.", "0.")).when(three.isin("", "-0", "-"), "0").otherwise(three)
    return F.when(vnd.isNull(), "").otherwise(F.concat(text, F.when(F.abs(d) > IMPLAUSIBLE, "!scale?").otherwise("")))


def confidence(vnd: Column, series: Column, unit: Column) -> Column:
    """Why a figure is not to be trusted; blank where nothing speaks against it."""
    percent = F.coalesce(series, F.lit("")).contains("%") | F.coalesce(unit, F.lit("")).contains("%")
    return F.when(vnd.isNull(), "").when(percent, "not_currency").when(F.abs(vnd) > IMPLAUSIBLE, "implausible").otherwise("")


def times(amount: Column, n: int) -> Column:
    """n times an amount, to be compared: a decimal where amounts are whole numbers, as the product of large ones is no long."""
    return amount * F.lit(Decimal(n))


def out_of_magnitude(value: Column, median: Column) -> Column:
    """Whether a value is a hundred times off a median, either way."""
    return (times(value, 100) < median) | (value > times(median, 100))


def magnitude_flag(value: Column, median: Column) -> Column:
    """MAGNITUDE? for a value a hundred times off its history's median."""
    return F.when((median > 0) & out_of_magnitude(value, median), "MAGNITUDE?").otherwise("")
