"""Text clean-up, hashing, language and tokens as Column expressions."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Mapping
from functools import reduce
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from slantwise import constants as K
from slantwise.functions.arrays import contiguous_ngrams, let, running

# Characters that canonical composition never changes, alone or next to each
# other: everything up to the combining marks, and general punctuation. A class
# of two ranges scans fast; other scripts take the Python path, where text that
# is composed already is recognised quickly.
NFC_STABLE_RANGES = r"\x00-\x{2FF}\x{2002}-\x{2064}"
MAY_NEED_NFC = "[^" + NFC_STABLE_RANGES + "]"

# A word of each phrase in ``K.BOILERPLATE``, by its first letter and its rest.
BOILERPLATE_WORD = "(?i)[nacr](?:ewsletter|lick|dvertisement|rticle|opyright|eserved)"

# Named character references, by name without the closing semicolon.
ENTITIES = {name[:-1]: value for name, value in html5.items() if name.endswith(";")}
# What the numeric references 128 to 159 stand for.
C1_REFERENCES = [bytes([code]).decode("cp1252", "ignore") or chr(code) for code in range(128, 160)]
NO_CHARACTER = "\ufffd"
FIRST_CHARACTER = 9

# What stands for a piece of markup in pruned HTML.
NODE, TITLE_START, TITLE_END = "\x01", "\x02", "\x03"
# Possessive here, so that a tag with very many attributes needs no stack.
JAVA_MARKUP = K.MARKUP.replace(K.TAG_REST, K.TAG_REST.replace("*", "*+"))


def _nfc_udf():
    """Built where it is used, so workers need no copy of this package."""

    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return F.pandas_udf(compose, StringType())


def nfc(text: Column) -> Column:
    """Canonical composition. Only text that may change travels to Python."""
    return F.coalesce(_nfc_udf()(F.when(text.rlike(MAY_NEED_NFC), text)), text)


def strip_ws(text: Column) -> Column:
    """Trim Unicode whitespace on both ends."""
    return F.regexp_replace(text, f"^{K.WS}+|{K.WS}+$", "")


def collapse_ws(text: Column) -> Column:
    """Every run of Unicode whitespace becomes one space; ends are trimmed."""
    return F.trim(F.regexp_replace(text, K.WS + "+", " "))


def normalize_text(text: Column) -> Column:
    """Compose, straighten quotes and dashes, drop links, addresses and boilerplate.

    Costly patterns run only over texts that hold what they cannot match without. A piece that is
    dropped leaves a space, so no word of a phrase arises on the way.
    """
    out = nfc(text)
    for mark, plain in (("‘", "'"), ("’", "'"), ("“", '"'), ("”", '"'), ("—", " -- "), ("–", " - ")):
        out = F.replace(out, F.lit(mark), F.lit(plain))
    out = F.regexp_replace(out, K.URL, " ")
    out = let(out, lambda x: F.when(x.contains("@"), F.regexp_replace(x, K.EMAIL, " ")).otherwise(x))
    return collapse_ws(let(out, lambda x: F.when(x.rlike(BOILERPLATE_WORD), _without_boilerplate(x)).otherwise(x)))


def _without_boilerplate(text: Column) -> Column:
    return reduce(lambda out, pattern: F.regexp_replace(out, pattern, " "), K.BOILERPLATE, text)


def text_hash(text: Column) -> Column:
    """SHA-256 of the text, blind to case and to the amount of whitespace."""
    return F.sha2(collapse_ws(F.lower(text)), 256)


def tokens(text: Column) -> Column:
    """Lower-cased tokens of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(K.TOKEN), F.lit(0))


def content_tokens(text: Column, stop_words: Iterable[str] = K.STOP_WORDS) -> Column:
    """Tokens without stop words; a set test per token, not a list search."""
    words = sorted(set(stop_words))
    if not words:
        return tokens(text)
    return F.filter(tokens(text), lambda token: ~token.isin(words))


def ngrams(
    text: Column,
    ngram_range: tuple[int, int] = K.NGRAM_RANGE,
    stop_words: Iterable[str] = K.STOP_WORDS,
) -> Column:
    """N-grams over the content tokens, so they bridge removed stop words."""
    return contiguous_ngrams(content_tokens(text, stop_words), *ngram_range)


def simple_tokens(text: Column) -> Column:
    """Variant used by the light scorer: ``a-z 0-9 ' -`` kept, no stop words."""
    kept = F.regexp_replace(F.lower(text), r"[^a-z0-9'\-]+", " ")
    return F.filter(F.split(kept, " "), lambda token: token != "")


def detect_language(
    text: Column,
    words: Mapping[str, Iterable[str]] = K.FUNCTION_WORDS,
    sample_chars: int | None = None,
) -> Column:
    """Language whose function words occur most often in the text.

    ``sample_chars`` restricts the count to the start of the text. Ties go to the
    alphabetically first code; no hit gives ``unknown``. All
    counts come from one token array, so no row leaves its partition.
    """
    sample = text if sample_chars is None else F.left(text, F.lit(sample_chars))
    found = F.regexp_extract_all(F.lower(sample), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))

    def hits(sample: Column, lang: str) -> Column:
        return F.size(F.filter(sample, lambda token: token.isin(list(words[lang]))))

    def best(sample: Column) -> Column:
        ranked = [F.struct((-hits(sample, lang)).alias("hits"), F.lit(lang).alias("lang")) for lang in sorted(words)]
        return F.array_min(F.array(*ranked))

    winner = let(found, best)
    return F.when(winner["hits"] < 0, winner["lang"]).otherwise(F.lit("unknown"))


def decode_entities(text: Column) -> Column:
    """Decode numeric and named references, each once, from left to right.

    A name is all letters and digits behind the ``&``; the semicolon may be missing.
    Code points that are no character become U+FFFD; unknown names stay.
    """
    table = F.from_json(F.lit(json.dumps(ENTITIES)), "map<string,string>")
    reference = r"^(?:#([0-9]+)|#[xX]([0-9a-fA-F]+)|([A-Za-z][A-Za-z0-9]*));?"

    def character(decimal: Column, hexadecimal: Column) -> Column:
        number = F.when(decimal != "", decimal).otherwise(F.conv(hexadecimal, 16, 10)).try_cast("bigint")
        valid = number.between(FIRST_CHARACTER, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
        point = F.when(valid, number).otherwise(F.lit(ord(NO_CHARACTER)))
        plain = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
        c1 = F.get(F.array(*map(F.lit, C1_REFERENCES)), (point - 128).cast("int"))
        return F.when(point.between(128, 159), c1).otherwise(plain)

    def part(p: Column) -> Column:
        decimal, hexadecimal, name = (F.regexp_extract(p, reference, i) for i in (1, 2, 3))
        found = F.when(name != "", F.try_element_at(table, name)).when(
            (decimal != "") | (hexadecimal != ""), character(decimal, hexadecimal)
        )
        return F.coalesce(F.concat(found, F.regexp_replace(p, reference, "")), F.concat(F.lit("&"), p))

    def join_parts(parts: Column) -> Column:
        rest = F.transform(F.slice(parts, F.lit(2), F.size(parts)), part)
        return F.concat(F.get(parts, F.lit(0)), F.array_join(rest, ""))

    return F.when(text.contains("&"), let(F.split(text, "&"), join_parts)).otherwise(text)


def drop_subtrees(html: Column, tags: Iterable[str] = K.DROPPED_TAGS) -> Column:
    """Visible text with a mark for each piece of markup between.

    Markup is read by kind: comments, declarations, raw elements, and tags, whose
    quoted attributes may hold ``>``. Each of ``tags`` has a depth, one up at its start
    and one down, not below zero, at its end tag; text at a depth above zero is
    hidden. So an end tag without a start does nothing, subtrees may hold their own
    kind, and one that is never closed reaches to the end. Comments and raw elements
    that stay open reach there too.
    """
    counted = [tag for tag in tags if tag not in K.RAW_TAGS]
    clean = F.translate(html, NODE + TITLE_START + TITLE_END, "   ")
    pieces = F.struct(F.regexp_extract_all(clean, F.lit(JAVA_MARKUP), F.lit(0)).alias("marks"), F.split(clean, JAVA_MARKUP, -1).alias("texts"))

    def step(mark: Column, tag: str) -> Column:
        start = mark.rlike(rf"(?i)^<{tag}[\s/>]") & ~mark.endswith("/>")
        return F.when(start, 1).when(mark.rlike(rf"(?i)^</{tag}[\s/>]"), -1).otherwise(0)

    def steps(mark: Column) -> Column:
        found = [step(mark, tag) for tag in counted]
        return F.struct(*[x.alias(f"s{k}") for k, x in enumerate(found)], *[F.least(x, F.lit(0)).alias(f"l{k}") for k, x in enumerate(found)])

    def add(a: Column, b: Column) -> Column:
        sums = [(a[f"s{k}"] + b[f"s{k}"]).alias(f"s{k}") for k in range(len(counted))]
        lows = [F.least(a[f"l{k}"], a[f"s{k}"] + b[f"l{k}"]).alias(f"l{k}") for k in range(len(counted))]
        return F.struct(*sums, *lows)

    fields = [f"{kind}{k}" for kind in "sl" for k in range(len(counted))]
    zero = F.struct(*[F.lit(0).alias(name) for name in fields])

    def hidden(marks: Column) -> Column:
        """For each text: whether it stands inside a dropped subtree."""
        ahead = running(F.concat(F.transform(marks, steps), F.array(zero)), f"struct<{','.join(f'{name}:int' for name in fields)}>", zero, add)
        return F.transform(ahead, lambda x: F.greatest(F.lit(0), *[x[f"s{k}"] - x[f"l{k}"] for k in range(len(counted))]) > 0)

    def symbol(mark: Column) -> Column:
        return F.when(mark.rlike(r"(?i)^<title[\s/>]"), TITLE_START).when(mark.rlike(r"(?i)^</title[\s/>]"), TITLE_END).otherwise(NODE)

    def visible(found: Column) -> Column:
        marked = F.zip_with(
            F.concat(F.array(F.lit("")), F.transform(found["marks"], symbol)), found["texts"], lambda mark, text: F.struct(mark.alias("mark"), text.alias("text"))
        )
        everything = F.transform(marked, lambda x: F.concat(x["mark"], x["text"]))
        if not counted:
            return F.array_join(everything, "")
        kept = F.zip_with(marked, hidden(found["marks"]), lambda x, out: F.when(out, NODE).otherwise(F.concat(x["mark"], x["text"])))
        some = F.exists(found["marks"], lambda mark: mark.rlike(rf"(?i)^<(?:{'|'.join(counted)})[\s/>]"))
        return F.array_join(F.when(some, kept).otherwise(everything), "")

    return let(pieces, visible)


def html_text(pruned: Column) -> Column:
    """Text nodes, each trimmed, joined by one space."""
    nodes = F.split(decode_entities(pruned), f"[{NODE}{TITLE_START}{TITLE_END}]")
    return F.array_join(F.filter(F.transform(nodes, strip_ws), lambda node: node != ""), " ")


def html_title(pruned: Column) -> Column:
    """Text of the first ``title`` element, its nodes trimmed, or an empty string."""
    inner = F.regexp_extract(pruned, f"{TITLE_START}([^{TITLE_END}]*)", 1)
    return F.array_join(F.transform(F.split(decode_entities(inner), f"[{NODE}{TITLE_START}]"), strip_ws), "")
