"""Normalisers for price, weight and size: free text in, DECIMAL(18,2) out.

All are built-in column expressions, so they stay inside whole-stage codegen and
need no shuffle. Patterns are case-sensitive unless ``ignore_case`` is set.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.numbers import MONEY, comma_as_dot, leading_number
from shelfmark.functions.size_rules import (
    FEED_A_SIZES,
    FEED_B_SIZES,
    LEFT_TO_RIGHT_MARK,
    NOT_LETTERS,
    SizeRule,
)

# Price and weight patterns of the two feeds. The two currency
# signs are different characters (U+0111 and U+20AB).
PRICE_A = r"^[0-9]+(\.[0-9]{1,3})?đ$"
PRICE_B = r"^[0-9]{1,3}(\.[0-9]{3})*₫$"
WEIGHT_A = r"^([0-9]+(?:\.[0-9]{1,3})?) k?g$"
KILOS_A = "kg"
_B = r"[\t\n\f\r\p{Z}]"
WEIGHT_B_PLAIN = rf"^<?([0-9]+(?:\.[0-9]+)?)(?: g| kg| gram| grams| gr|g|gr)(?:{_B}*\(.*\))?$"
WEIGHT_B_OUNCES = r"^([0-9]+(?:\.[0-9]+)?) g / [0-9]+(?:,[0-9]+)? oz.*$"
WEIGHT_B_BELOW = rf"^<{_B}*([0-9]+(?:\.[0-9]+)?){_B}*g$"
WEIGHT_B_COMMA = rf"^([0-9]+(?:,[0-9]+)?){_B}*g.*$"
WEIGHT_B_NAMED = rf"^[a-zA-Z0-9]+{_B}+[0-9]+(?:,[0-9]+)?{_B}*g.*$"

_DIMS = ("length", "width", "height")


def _pattern(pattern: str, ignore_case: bool) -> str:
    return f"(?iu){pattern}" if ignore_case else pattern


def parse_price_a(price: Column, ignore_case: bool = False) -> Column:
    """``269.100đ`` is 269100.00; more than one dot group is not recognised.

    Every other text is NULL, also an empty one and "price on request".
    """
    plain = F.translate(price, "đĐ.", "")
    return F.when(price.rlike(_pattern(PRICE_A, ignore_case)), plain.try_cast(MONEY))


def parse_price_b(price: Column, ignore_case: bool = False) -> Column:
    """``1.290.000₫`` is 1290000.00; dots must separate groups of three."""
    return F.when(
        price.rlike(_pattern(PRICE_B, ignore_case)), F.translate(price, "₫.", "").try_cast(MONEY)
    )


def parse_weight_a(weight: Column, ignore_case: bool = False) -> Column:
    """Grams; kilograms are rounded to two places and then scaled."""
    number = F.regexp_extract(weight, _pattern(WEIGHT_A, ignore_case), 1).try_cast(MONEY)
    unit = F.lower(weight) if ignore_case else weight
    return F.when(unit.contains(KILOS_A), (number * 1000).try_cast(MONEY)).otherwise(number)


def parse_weight_b(weight: Column, ignore_case: bool = False) -> Column:
    """Grams from five notations. A ``kg`` suffix is accepted but not scaled."""

    def rule(pattern: str) -> str:
        return _pattern(pattern, ignore_case)

    named = F.substring_index(F.substring_index(weight, "g", 1), " ", -1)
    return (
        F.when(weight.rlike(rule(WEIGHT_B_PLAIN)), F.regexp_extract(weight, rule(WEIGHT_B_PLAIN), 1).try_cast(MONEY))
        .when(weight.rlike(rule(WEIGHT_B_OUNCES)), F.regexp_extract(weight, rule(WEIGHT_B_OUNCES), 1).try_cast(MONEY))
        .when(weight.rlike(rule(WEIGHT_B_BELOW)), F.regexp_extract(weight, rule(WEIGHT_B_BELOW), 1).try_cast(MONEY))
        .when(
            weight.rlike(rule(WEIGHT_B_COMMA)),
            comma_as_dot(F.regexp_extract(weight, rule(WEIGHT_B_COMMA), 1)).try_cast(MONEY),
        )
        .when(weight.rlike(rule(WEIGHT_B_NAMED)), leading_number(named))
    )


def _sql_text(text: str) -> str:
    return "r'" + text.replace("'", "\\u0027") + "'"


def _first_match(rules: Sequence[SizeRule], texts: dict[str, str], ignore_case: bool) -> str:
    """The three numbers of the first matching rule as ``part;part;part``, in SQL.

    A part is three flags (comma mode, scale, rounding order) and the number. One
    test per rule, then one replace that takes all three numbers at once.
    """
    if not rules:
        return "NULL"
    branches = []
    for rule in rules:
        pattern = _pattern(rule.pattern, ignore_case)
        parts = ";".join(
            f"{rule.comma[i]}{'t' if rule.scale[i] == 10 else 'u'}{rule.exact[i]}"
            + (f"${rule.groups[i]}" if rule.groups[i] else "")
            for i in range(3)
        )
        text = texts[rule.text]
        # all of the text is replaced; an anchored pattern may leave a line end
        anchored = rule.pattern.startswith("^")
        whole = rf"{pattern[:-1]}\s*$" if anchored else rf"^[\s\S]*?(?:{pattern})[\s\S]*$"
        branches.append(
            f"WHEN {text} RLIKE {_sql_text(pattern)}"
            f" THEN regexp_replace({text}, {_sql_text(whole)}, {_sql_text(parts)})"
        )
    return f"CASE {' '.join(branches)} END"


def _match_by_letters(rules: Sequence[SizeRule], texts: dict[str, str], letters: str) -> str:
    """The cascade cut down, before any regex, to the rules a text can match.

    Known letters lead to the rules with these letters, unknown ones to the open
    rules; the order of the rules is kept, so the first match is the same.
    """
    known = dict.fromkeys(form for rule in rules if rule.needs is None for form in sorted(rule.letters()))
    branches = []
    for form in known:
        able = [r for r in rules if (r.needs in form if r.needs else form in r.letters())]
        branches.append(f"WHEN {letters} = {_sql_text(form)} THEN {_first_match(able, texts, False)}")
    open_rules = [r for r in rules if r.needs]
    possible = " OR ".join(f"contains({letters}, {_sql_text(r.needs)})" for r in open_rules)
    branches.append(f"WHEN {possible} THEN {_first_match(open_rules, texts, False)}")
    return f"CASE {' '.join(branches)} END"


def _part_value(i: int) -> str:
    part, money = f"_hit[{i}]", "DECIMAL(18,2)"
    text = f"substr({part}, 4)"
    number = f"CASE WHEN startswith({part}, 'd') THEN translate({text}, ',', '.') ELSE {text} END"
    factor = f"CASE WHEN substr({part}, 2, 1) = 't' THEN 10 ELSE 1 END"
    digits = f"substring_index(substring_index({number}, ',', 1), '.', 2)"
    rounded = f"try_cast(try_cast({digits} AS {money}) * {factor} AS {money})"
    unrounded = f"try_cast(try_cast({number} AS DECIMAL(24,8)) * {factor} AS {money})"
    return f"CASE WHEN substr({part}, 3, 1) = 'y' THEN {unrounded} ELSE {rounded} END"


def with_size(df: DataFrame, size: str, rules: Sequence[SizeRule], ignore_case: bool = False) -> DataFrame:
    """Add ``length``, ``width`` and ``height`` in millimetres, read from ``size``."""
    mark = _sql_text(LEFT_TO_RIGHT_MARK)
    texts = {"raw": f"`{size}`", "trimmed": "_trimmed", "unmarked": f"trim(replace(`{size}`, {mark}, ''))"}
    if ignore_case:
        hit = _first_match(rules, texts, True)
    else:
        hit = _match_by_letters(rules, texts, "_letters")
    prepared = df.withColumns(
        {"_trimmed": F.trim(F.col(size)), "_letters": F.translate(F.col(size), NOT_LETTERS, "")}
    )
    parts = prepared.withColumn("_hit", F.expr(f"split({hit}, ';')")).drop("_trimmed", "_letters")
    return parts.withColumns({dim: F.expr(_part_value(i)) for i, dim in enumerate(_DIMS)}).drop("_hit")


def with_size_a(df: DataFrame, size: str = "size", ignore_case: bool = False) -> DataFrame:
    return with_size(df, size, FEED_A_SIZES, ignore_case)


def with_size_b(df: DataFrame, size: str = "size", ignore_case: bool = False) -> DataFrame:
    return with_size(df, size, FEED_B_SIZES, ignore_case)
