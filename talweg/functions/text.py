"""Text keys, mojibake detection and repair, alias stems, condition labels.

Everything here is a built-in column expression, so it stays inside the JVM;
only the fuzzy tail of ``condition_label`` needs Python, and that part sees
nulls for every row the expressions have already decided.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unicode white space as Python's str.split sees it.
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"
# The same characters one by one, for trimming without a search.
WHITE_CHARACTERS = "".join(map(chr, (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use`` (a let-binding)."""
    return F.element_at(F.transform(F.array(value), use), 1)


def collapse(value: Column) -> Column:
    """Trim and collapse every run of white space to one space."""
    return F.trim(F.regexp_replace(value, WHITESPACE, " "))


def strip(value: Column) -> Column:
    """Trim Unicode white space at both ends, keeping the inside as it is."""
    return F.btrim(value, F.lit(WHITE_CHARACTERS))


def stringify(value: Column) -> Column:
    return F.coalesce(strip(value.cast("string")), F.lit(""))


def lookup_key(value: Column) -> Column:
    """Case-folded, space-collapsed comparison key."""
    folded = F.lower(collapse(value.cast("string")))
    return F.coalesce(F.replace(folded, F.lit("ß"), F.lit("ss")), F.lit(""))


def theme_key(value: Column) -> Column:
    joined = F.regexp_replace(stringify(value), r"(?U)[\s\x1c-\x1f_]+", "_")
    return F.lower(F.regexp_replace(joined, "^_+|_+$", ""))


def profile_key(value: Column) -> Column:
    """Slash-separated profile name with every part normalised like a theme."""
    parts = F.split(F.replace(stringify(value), F.lit("\\"), F.lit("/")), "/")
    return F.array_join(F.filter(F.transform(parts, theme_key), lambda p: p != ""), "/")


def attribute_key(value: Column) -> Column:
    return F.lower(stringify(value))


@lru_cache(maxsize=1)
def _ascii_fold_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Per-character ASCII remainders of the NFKD form, derived from Unicode data."""
    single_from, single_to, several = [], [], []
    for code in range(0x80, 0x110000):
        if 0xD800 <= code <= 0xDFFF:
            continue
        char = chr(code)
        kept = "".join(c for c in unicodedata.normalize("NFKD", char) if c < "\x80")
        if len(kept) == 1:
            single_from.append(char)
            single_to.append(kept)
        elif kept:
            several.append((char, kept))
    return "".join(single_from), "".join(single_to), tuple(several)


def ascii_fold(value: Column) -> Column:
    """NFKD-decompose and drop whatever is not ASCII.

    Plain ASCII passes through. Characters that fold to one ASCII character go
    through ``translate``; the few that fold to several are expanded only in
    rows that contain one (the branch is lazy).
    """
    single_from, single_to, several = _ascii_fold_tables()
    # One literal, folded to an array of pairs when the plan is optimised.
    table = "\x02".join(f"{a}\x03{b}" for a, b in several)
    expansions = F.map_entries(F.str_to_map(F.lit(table), F.lit("\x02"), F.lit("\x03")))
    # Cheap range test first, then the exact one by dictionary.
    unusual = value.rlike(r"[\x{BC}-\x{BE}\x{132}\x{133}\x{180}-\x{10FFFF}]")
    without = F.translate(value, "".join(a for a, _ in several), "")
    has_several = unusual & (F.length(without) < F.length(value))
    expanded = F.when(
        has_several,
        F.aggregate(expansions, value, lambda text, pair: F.replace(text, pair["key"], pair["value"])),
    ).otherwise(value)
    folded = F.regexp_replace(F.translate(expanded, single_from, single_to), r"[^\x00-\x7F]", "")
    return F.when(value.rlike(r"[^\x00-\x7F]"), folded).otherwise(value)


def rule_key(value: Column) -> Column:
    """Comparison key of rule values: folded, collapsed, upper case; null gives ''."""
    folded = F.regexp_replace(ascii_fold(value), r"[\s\x1c-\x1f]+", " ")
    return F.coalesce(F.upper(F.trim(folded)), F.lit(""))


# Lead characters of double-encoded UTF-8 and the broken dash.
MOJIBAKE_LEADS = "ÃÂĂ"
BROKEN_DASH = "¿"
# Characters Windows-1252 assigns to bytes 0x80-0x9F, with their bytes.
CP1252_CHARS = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = (
    "\x80\x82\x83\x84\x85\x86\x87\x88\x89\x8a\x8b\x8c\x8e"
    "\x91\x92\x93\x94\x95\x96\x97\x98\x99\x9a\x9b\x9c\x9e\x9f"
)


def mojibake_score(value: Column) -> Column:
    text = F.coalesce(value, F.lit(""))
    return (
        F.regexp_count(text, F.lit(r"[\x80-\x9F]"))
        + F.regexp_count(text, F.lit(rf"(?<=[{MOJIBAKE_LEADS}])[\x80-\xBF]"))
        + F.regexp_count(text, F.lit("â€"))
    )


def looks_like_mojibake(value: Column) -> Column:
    return mojibake_score(value) > 0


def _redecode_latin1(value: Column) -> Column:
    """Latin-1 bytes of the text read as UTF-8; null where either step is invalid."""
    raw = F.encode(F.when(value.rlike(r"^[\x00-\xFF]*$"), value), "ISO-8859-1").cast("string")
    return F.when(F.is_valid_utf8(raw), raw)


def _redecode_cp1252(value: Column) -> Column:
    encodable = value.rlike(rf"^[\x00-\x7F\xA0-\xFF{CP1252_CHARS}]*$")
    as_bytes = F.translate(F.when(encodable, value), CP1252_CHARS, CP1252_BYTES)
    return _redecode_latin1(as_bytes)


def _repair_round(state: Column) -> Column:
    """One round over struct(score, text): take the best strictly better candidate."""

    def candidate(text: Column, order: int) -> Column:
        return F.when(
            text.isNotNull() & (mojibake_score(text) < state["score"]),
            F.struct(
                mojibake_score(text).alias("score"),
                F.length(text).alias("size"),
                F.lit(order).alias("order"),
                text.alias("text"),
            ),
        )

    best = F.array_min(
        F.array_compact(
            F.array(
                bind(_redecode_latin1(state["text"]), lambda t: candidate(t, 0)),
                bind(_redecode_cp1252(state["text"]), lambda t: candidate(t, 1)),
            )
        )
    )
    improved = bind(
        best,
        lambda b: F.when(
            b.isNotNull(), F.struct(b["score"].alias("score"), b["text"].alias("text"))
        ).otherwise(state),
    )
    return F.when(state["score"] == 0, state).otherwise(improved)


def repair_mojibake(value: Column) -> Column:
    """Undo up to two rounds of double encoding; null unless fully repaired."""
    start = F.struct(mojibake_score(value).alias("score"), value.alias("text"))
    repaired = bind(bind(start, _repair_round), _repair_round)
    return F.when(
        looks_like_mojibake(value),
        bind(
            repaired,
            lambda r: F.when((r["score"] == 0) & (r["text"] != value), r["text"]),
        ),
    )


def repair_title(value: Column) -> Column:
    """Latin-1 round only, applied where a lead character is present."""
    return F.when(
        value.rlike("[ÃÂ]"), F.coalesce(_redecode_latin1(value), value)
    ).otherwise(value)


def canonical_domain_text(
    value: Column, ends: Callable[[Column], Column] = strip, runs: Callable[[Column], Column] = collapse
) -> Column:
    """Text with hyphens for broken dashes and lone question marks, and white space collapsed; null gives ''.

    ``ends`` trims before the dashes are looked for, ``runs`` collapses afterwards.
    """
    dashed = F.replace(ends(value), F.lit(BROKEN_DASH), F.lit("-"))
    return F.coalesce(runs(F.replace(dashed, F.lit(" ? "), F.lit(" - "))), F.lit(""))


# Phrases and prepositions an alias stem leaves out.
STEM_PHRASES = ("AREA DE PRESERVACAO PERMANENTE", "A RECOMPOR")
STEM_PREPOSITIONS = "DAS|DOS|DA|DO|DE"


def alias_stem(value: Column) -> Column:
    text = F.regexp_replace(rule_key(value), "^APP_", "")
    for phrase in STEM_PHRASES:
        text = F.replace(text, F.lit(phrase), F.lit(""))
    text = F.regexp_replace(text, STEM_PREPOSITIONS, " ")
    text = F.trim(F.regexp_replace(text, r"\s+", " "))
    return F.regexp_replace(text, "^(.{4,})S$", "$1")


# Condition labels in matching order.
CONDITION_LABELS = {
    "ANALISADO": "Analisado",
    "CANCELADO": "Cancelado",
    "AGUARDANDO ANALISE": "Aguardando analise",
}
CONDITION_CUTOFF = 0.8


@F.arrow_udf(StringType())
def _closest_condition(keys: pa.Array) -> pa.Array:
    from difflib import get_close_matches

    coded = keys.dictionary_encode()
    found = [
        get_close_matches(key, list(CONDITION_LABELS), n=1, cutoff=CONDITION_CUTOFF)
        for key in coded.dictionary.to_pylist()
    ]
    labels = pa.array([CONDITION_LABELS[f[0]] if f else None for f in found], pa.string())
    return labels.take(coded.indices)


def condition_label(value: Column, key: Column | None = None) -> Column:
    """Label of a registry condition: contained keyword, then closest, then trimmed text.

    ``key`` is the rule key of ``value`` where a column holds it; else it is worked out wherever it is used.
    """
    key = rule_key(value) if key is None else key
    contained = F.coalesce(
        *[F.when(F.contains(key, F.lit(k)), F.lit(v)) for k, v in CONDITION_LABELS.items()]
    )
    # A ratio of at least 0.8 bounds the length, so most texts never reach Python.
    reach = CONDITION_CUTOFF / (2 - CONDITION_CUTOFF)
    size = F.length(key)
    near = F.lit(False)
    for label in CONDITION_LABELS:
        near = near | size.between(len(label) * reach, len(label) / reach)
    residual = F.when(contained.isNull() & near, key)
    return F.coalesce(contained, _closest_condition(residual), strip(value))


# Theme spellings that carry a state code.
STATE_KEY_FAMILIES = (
    "app_car|rl_car|reserva_legal_car|pol_pcd_app_car|pol_pcd_rl_car"
    "|sld_pcd_app_car|sld_pcd_rl_car|md_pcd_app_car|md_pcd_rl_car"
)


def state_code(*candidates: Column, known: tuple[str, ...], families: str = STATE_KEY_FAMILIES) -> Column:
    """First known state code found in the candidates, by theme pattern."""
    found = []
    for candidate in candidates:
        code = F.regexp_extract(
            F.lower(candidate.cast("string")), rf"(?:{families})_([a-z]{{2}})(?:_|\.|$)", 1
        )
        found.append(F.when(code.isin(*known), code))
    return F.coalesce(*found)
