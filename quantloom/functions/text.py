"""O6.1-O6.6: printed labels, amounts and units.

Rules that SQL can say are columns; the rest are plain functions that pandas UDFs run over
*distinct* texts, joined back by equality, so their cost follows the vocabulary and not the rows.
"""

from __future__ import annotations

import re
from decimal import ROUND_HALF_UP, Decimal, InvalidOperation

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quantloom.functions.nullsafe import col

# --- labels -----------------------------------------------------------------------------

# Bullets, circled numbers, and what stands between the numbers of a note reference.
_BULLETS, _CIRCLED, _AND = "ㆍ•·→▶◆■□●○△▷", "①-⑳", ",\\s와과및"
#: Roman numerals up to 39, well formed, as letters before a dot or as signs of their own.
_ROMAN = "(?:X{1,3}(?:IX|IV|V?I{0,3})|IX|IV|VI{0,3}|I{1,3}|x{1,3}(?:ix|iv|v?i{0,3})|ix|iv|vi{0,3}|i{1,3})"
#: O6.4: a label begins with any number of marks, each with white space after it; one pattern takes them all.
LABEL_LEAD = f"^\\s*(?:(?:[{_BULLETS}]|[Ⅰ-ⅿ]+[.]?|{_ROMAN}[.]|[{_CIRCLED}]+[.]?|(?:[0-9]+|[가-힣])[.]|[(](?:[0-9]+|[A-Za-z])[)])\\s*)+"
#: Note references, wherever they stand, and what is left of one whose bracket was cut off at the end.
LABEL_NOTES = f"[(<]\\s*(?:주석?|[Nn][Oo][Tt][Ee]s?)\\s*[0-9][0-9{_AND}]*[)>]?|,[0-9,\\s]*>\\s*$"
#: Brackets go, and white space between Hangul, which is only spread out; other white space is one space.
LABEL_LOOSE = "[\\[\\]]|(?<=[가-힣])\\s+(?=[가-힣])"


def label_key(label: Column | str) -> Column:
    """O6.4: the label without numbering, bullets, note references, brackets and loose white space."""
    plain = F.regexp_replace(F.translate(col(label), "　[]", " "), LABEL_LEAD, "")
    closed = F.regexp_replace(F.regexp_replace(plain, LABEL_NOTES, ""), LABEL_LOOSE, "")
    return F.trim(F.regexp_replace(closed, "\\s+", " "))


def label_key_of(label: str | None) -> str:
    """The same for one label, in Python."""
    plain = re.sub(LABEL_LEAD, "", (label or "").translate({0x3000: " ", ord("["): None, ord("]"): None}))
    return " ".join(re.sub(LABEL_LOOSE, "", re.sub(LABEL_NOTES, "", plain)).split())


# --- amounts ----------------------------------------------------------------------------

#: Larger amounts are two numbers run together.
SANE_MOST = 10**16
_COMPLETE = re.compile(r"[(]?[-−△▲]?\s*(?:\d{1,3}(?:,\d{3})+|\d+)(?:\.\d+)?[)]?")
_NEGATIVE = re.compile(r"\((?P<a>[^()]*)\)|\(-\)(?P<b>.*)|[-−△▲]+(?P<c>.*)", re.S)
_BLANK = re.compile(r"[-−–—.\s]*")
_WON = re.compile(r"원(?=\)?$)")
#: A line under a figure, as a cell may hold it.
_RULE = re.compile(r"[=_═─]+$")
_DASH = re.compile(r"[-−–—]+")
_RANGE = re.compile("[~～〜]|부터|까지")
_PARTS = (
    # What a number broken by spaces looks like; joined only if the whole is well formed.
    re.compile(r"(?:\d{1,3},\s+)+\d{3}|(?:\d{1,3}(?:,\d{3})*,\s+)+\d{3}(?:,\d{3})*"),
    re.compile(r"\d{1,3}(?:\s+\d{3}){2,}"),
    re.compile(r"(?:\d\s+)+\d{1,2}(?:,\d{3})+|\d{1,2}\s+\d{1,2}(?:,\d{3})+"),
)


def _rejoined(text: str) -> str:
    for shape in _PARTS:
        if shape.fullmatch(text):
            joined = re.sub(r"\s+", "", text)
            # Leading digits belong to the number only if they complete a group of three.
            if shape is not _PARTS[2] or len(joined.split(",")[0]) == 3:
                if _COMPLETE.fullmatch(joined):
                    return joined
    return text


def amount(text: str | None, multiplier: int = 1) -> Decimal | None:
    """O6.5: the exact amount. NULL where the cell doesn't say: blanks, ranges, two different numbers, dashes on a line of their own beside a number, more than 1e16."""
    if text is None:
        return None
    lines = [part.strip() for part in text.splitlines() if part.strip()]
    if len(lines) > 1 and any(_DASH.fullmatch(part) for part in lines):
        return None  # a blank cell run together with another one: no sign
    text = _rejoined(_RULE.sub("", text.strip()).strip())
    words = text.split()
    if len(words) > 1 and all(_COMPLETE.fullmatch(w) for w in words):
        if len(set(words)) > 1:
            return None
        text = words[0]
    text = re.sub(r"\s+", "", text)
    if _WON.search(text):
        text, multiplier = _WON.sub("", text), 1
    if _BLANK.fullmatch(text) or _RANGE.search(text):
        return None
    minus = _NEGATIVE.fullmatch(text)
    if minus:
        text = next(g for g in minus.groups() if g is not None).lstrip("-−△▲")
    text = text.rstrip(",").replace(",", "")
    if not re.fullmatch(r"\d+(?:\.\d+)?|\.\d+", text):
        return None
    try:
        value = Decimal(text) * multiplier
    except InvalidOperation:
        return None
    if abs(rounded(value)) > SANE_MOST:
        return None
    return -value if minus else value


def rounded(value: Decimal) -> int:
    """Half up, away from zero."""
    return int(value.to_integral_value(rounding=ROUND_HALF_UP))


_AMOUNT = T.StructType([T.StructField("value", T.LongType()), T.StructField("exact", T.DecimalType(38, 6))])


@F.pandas_udf(_AMOUNT)
def _amounts(texts: pd.Series, multipliers: pd.Series) -> pd.DataFrame:
    found = [amount(t, int(m)) if m == m and m is not None else None for t, m in zip(texts, multipliers, strict=True)]
    return pd.DataFrame({"value": pd.Series([None if x is None else rounded(x) for x in found], dtype="Int64"), "exact": [None if x is None or x == x.to_integral_value() else x.quantize(Decimal("0.000001")) for x in found]})


def with_amounts(df: DataFrame, text: str, multiplier: Column, value: str = "value", exact: str = "exact") -> DataFrame:
    """O6.5 for a column: common forms in SQL, the rest through the parser, once per distinct text and multiplier."""
    t = F.trim(F.col(text))
    plain = r"^[(]?-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]{1,15})[)]?$"
    simple = t.rlike(plain) & (t.startswith("(") == t.endswith(")")) & ~t.startswith("(-")
    digits = F.regexp_replace(t, "[^0-9]", "").try_cast("decimal(38,0)")
    signed = F.when(t.startswith("(") | t.startswith("-"), -digits).otherwise(digits) * F.col("__m")
    quick = F.when(F.abs(signed) <= SANE_MOST, signed.cast("long"))
    rows = df.withColumn("__m", multiplier.cast("long"))
    marked = rows.withColumn("__simple", F.coalesce(simple, F.lit(False)))
    hard = marked.where(~F.col("__simple") & F.col(text).isNotNull() & F.col("__m").isNotNull()).select(F.col(text).alias("__t"), F.col("__m").alias("__tm")).distinct().withColumn("__a", _amounts("__t", "__tm"))
    out = marked.join(hard, (F.col(text) == F.col("__t")) & (F.col("__m") == F.col("__tm")), "left")
    return out.withColumns({value: F.when(F.col("__simple"), quick).otherwise(F.col("__a.value")), exact: F.when(~F.col("__simple"), F.col("__a.exact"))}).drop("__m", "__simple", "__t", "__tm", "__a")


#: O6.6: fixed values, what a caption's unit multiplies by.
UNITS = (("조\\s*원", 10**12), ("십억\\s*원", 10**9), ("억\\s*원", 10**8), ("백만\\s*원", 10**6), ("천\\s*원", 10**3), ("(?<![가-힣])원", 1))


def unit_multiplier(caption: Column | str) -> Column:
    """O6.6: the declared multiplier; NULL without a declaration or with one in foreign money."""
    c = F.regexp_extract(col(caption), "단위\\s*[:：]?\\s*([^)\\]]*)", 1)
    foreign = c.rlike("(?i)USD|US\\$|JPY|EUR|CNY|달러|엔화|유로|위안")
    out = F.lit(None).cast("long")
    for pattern, times in reversed(UNITS):
        out = F.when(c.rlike(pattern), F.lit(times).cast("long")).otherwise(out)
    return F.when(~foreign, out)


# --- label to account -------------------------------------------------------------------

ACCEPT, FUZZY = 0.88, 0.88


def jaro_winkler(a: str, b: str) -> float:
    """Jaro similarity, raised by a common start of up to 4 characters where it is over 0.7."""
    if a == b:
        return 1.0 if a else 0.0
    if not a or not b:
        return 0.0
    reach = max(len(a), len(b)) // 2 - 1
    used = [False] * len(b)
    left: list[str] = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                left.append(c)
                break
    m = len(left)
    if not m:
        return 0.0
    right = [c for c, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
    score = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if score > 0.7:
        start = 0
        while start < min(4, len(a), len(b)) and a[start] == b[start]:
            start += 1
        score += start * 0.1 * (1 - score)
    return score


def alias_score(label: str, alias: str, threshold: float = FUZZY) -> float:
    """O6.2: 0.90 + 0.09 x length ratio if one holds the other (unless short and far longer), else Jaro-Winkler from ``threshold``."""
    if not label or not alias:
        return 0.0
    short, long = sorted((len(label), len(alias)))
    if alias in label or label in alias:
        ratio = short / long
        return 0.0 if ratio < 0.65 and short <= 4 else 0.90 + 0.09 * ratio
    score = jaro_winkler(label, alias) if short >= 3 else 0.0
    return score if score >= threshold else 0.0


def best_alias(label: str, aliases: list[tuple[str, str]]) -> tuple[str, float] | None:
    """The code of the best-scoring (code, alias); the first one of equal scores."""
    best = None
    for code, alias in aliases:
        score = alias_score(label, alias)
        if score and (best is None or score > best[1]):
            best = code, score
    return best


def map_labels(labels: DataFrame, aliases: DataFrame, blocked: list[str] | None = None, label: str = "label", section: str = "section", most: int = 100_000) -> DataFrame:
    """O6.1, O3.17: (section, label, code, stage, confidence) of each distinct (section, label).

    Stages in order: exact in the section, normalized in the section, exact anywhere, normalized
    anywhere, blocked, fuzzy in the section; below ``ACCEPT`` there is no code. ``aliases``:
    (section, code, alias, place), a dictionary whose size doesn't follow the data; smaller
    places win ties; more than ``most`` entries are an error, since each worker holds them.
    """
    own = labels.select(section, label).where(F.col(label).isNotNull()).distinct().withColumn("__key", label_key(label))
    table = aliases.withColumn("__akey", label_key("alias"))

    def pick(df: DataFrame, on: str, within: bool, name: str) -> DataFrame:
        keys = ["__s", "__k"] if within else ["__k"]
        best = table.select(F.col(section).alias("__s"), F.col(on).alias("__k"), "code", "place").groupBy(*keys).agg(F.min_by("code", "place").alias(name))
        left = F.col(label) if on == "alias" else F.col("__key")
        cond = (left == F.col("__k")) & (F.col(section) == F.col("__s") if within else F.lit(True))
        return df.join(best, cond, "left").drop("__s", "__k")

    staged = own
    for on, within, name in (("alias", True, "c1"), ("__akey", True, "c2"), ("alias", False, "c3"), ("__akey", False, "c4")):
        staged = pick(staged, on, within, name)
    stop = F.col("__key").isin(*blocked) if blocked else F.lit(False)
    sure = F.coalesce("c1", "c2", "c3", "c4")
    rows = [(r[section], r["code"], r["__akey"]) for r in table.select(section, "code", "__akey", "place").orderBy("place").limit(most + 1).collect()]
    if len(rows) > most:
        raise ValueError(f"the dictionary has more than {most} entries")
    by_section: dict[str, list[tuple[str, str]]] = {}
    for s, code, key in rows:
        by_section.setdefault(s, []).append((code, key))
    found = T.StructType([T.StructField("code", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.pandas_udf(found)
    def fuzzy(sections: pd.Series, keys: pd.Series) -> pd.DataFrame:
        out = [best_alias(k, by_section.get(s, [])) for s, k in zip(sections, keys, strict=True)]
        return pd.DataFrame({"code": [x[0] if x else None for x in out], "score": [x[1] if x else None for x in out]})

    tail = staged.where(sure.isNull() & ~stop).select(F.col(section).alias("__s"), F.col("__key").alias("__k")).distinct().withColumn("__f", fuzzy("__s", "__k"))
    out = staged.join(tail, (F.col(section) == F.col("__s")) & (F.col("__key") == F.col("__k")), "left")
    stage = F.when(F.col("c1").isNotNull() | F.col("c3").isNotNull(), "exact").when(F.col("c2").isNotNull() | F.col("c4").isNotNull(), "normalized").when(stop, "blocked").when(F.col("__f.score") >= ACCEPT, "fuzzy").otherwise("unknown")
    stage = F.when(F.col("c1").isNotNull(), "exact").when(F.col("c2").isNotNull(), "normalized").when(F.col("c3").isNotNull(), "exact").otherwise(stage)
    confidence = F.when(sure.isNotNull(), 1.0).when(~stop & (F.col("__f.score") >= ACCEPT), F.col("__f.score")).otherwise(0.0)
    return out.select(section, label, F.coalesce(sure, F.when(~stop & (F.col("__f.score") >= ACCEPT), F.col("__f.code"))).alias("code"), stage.alias("stage"), confidence.alias("confidence"))


def with_concepts(mapped: DataFrame, lines: DataFrame, concepts: DataFrame, taxonomy: DataFrame, section: str = "section", label: str = "label") -> DataFrame:
    """O6.3: lines with a code: their own mapping, else their concept's, else what the taxonomy's labels say.

    ``lines``: (section, label, concept, ...); ``concepts``: (concept, code); ``taxonomy``: (label,
    concept) of the published label index. A taxonomy hit comes before a fuzzy one. stage says which one it was.
    """
    by_label = taxonomy.withColumn("__key", label_key("label")).groupBy("__key").agg(F.min("concept").alias("__by_label"))
    known = concepts.groupBy("concept").agg(F.min("code").alias("code"))
    own = mapped.select(F.col(section).alias("__s"), F.col(label).alias("__l"), F.col("code").alias("__own"), F.col("stage").alias("__stage"))
    out = lines.withColumn("__key", label_key(label)).join(own, (F.col(section) == F.col("__s")) & F.col(label).eqNullSafe(F.col("__l")), "left").join(by_label, "__key", "left")
    out = out.join(known.select("concept", F.col("code").alias("__concept")), "concept", "left").join(known.select(F.col("concept").alias("__by_label"), F.col("code").alias("__taxonomy")), "__by_label", "left")
    sure = F.when(F.col("__stage").isin("exact", "normalized"), F.col("__own"))
    fuzzy = F.when(F.col("__stage") == "fuzzy", F.col("__own"))
    stage = F.when(sure.isNotNull(), F.col("__stage")).when(F.col("__concept").isNotNull(), "concept").when(F.col("__taxonomy").isNotNull(), "taxonomy").when(fuzzy.isNotNull(), "fuzzy").otherwise(F.coalesce("__stage", F.lit("unknown")))
    blocked = F.col("__stage") == "blocked"
    code = F.when(~F.coalesce(blocked, F.lit(False)), F.coalesce(sure, F.col("__concept"), F.col("__taxonomy"), fuzzy))
    return out.select(*lines.columns, code.alias("code"), F.when(blocked, "blocked").otherwise(stage).alias("stage"))
