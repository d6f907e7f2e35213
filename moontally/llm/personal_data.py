"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Everything is DataFrame functions. Matches of a pattern are the leftmost ones that do not overlap. Their places come from the
pieces between them: ``split`` gives the pieces, ``regexp_extract_all`` the matches, and lengths add
up to offsets in code points. A text is scanned only by the patterns of which it holds a needed character.

The patterns start where a run of their first character class starts (or where the match before
ended) and take runs possessively. That finds the same matches as without, in time
proportional to the text.

Defined cases: a null or empty text has no spans, and redaction leaves it as it is. Texts of any
length are searched whole. Repeated rows are treated one by one. Other columns keep their values, whatever
their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Score from which spans of the added kinds count; spans of the base kinds always do.
THRESHOLD = 0.5
#: Code points on either side of a match, up to the next match, in which context words count.
CONTEXT = 40
_BLOCK = 256


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    #: A text without a match of this cannot hold one of the pattern.
    needs: str
    #: Score of a match that passed its check.
    score: float
    #: Words nearby that add 0.3.
    context: str
    base: bool = True


KINDS = (
    Kind("email", r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.7, r"\b(mail|email|contact|write)\b"),
    Kind("ip", r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}", "[0-9]\\.[0-9]", 0.6, r"\b(ip|host|server|address|login)\b"),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", 0.7, r"\b(card|visa|credit|payment|mastercard)\b"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "\\+[0-9]", 0.6, r"\b(phone|call|tel|fax|mobile)\b"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:(?:\x20[A-Z0-9]{4}){2,7}(?:\x20[A-Z0-9]{1,3})?|[A-Z0-9]{11,30})(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.7, r"\b(iban|account|bank|konto)\b", False),
    Kind("local_phone", r"(?<![0-9A-Za-z+.-])[0-9]{3}[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])", "[0-9]", 0.3, r"\b(phone|call|tel|fax|mobile)\b", False),
)


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check: every second digit from the right counts doubled."""
    doubled = F.array(*(F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)))

    def add(total: Column, place: Column) -> Column:
        digit = F.substring(number, F.length(number) - place, F.lit(1)).cast("int")
        return total + F.when(place % 2 == 1, F.get(doubled, digit)).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def mod97(code: Column) -> Column:
    """Whether an account code leaves 1: its first four characters go last, letters count from 10."""
    moved = F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, F.lit(1), F.lit(4)))

    def step(rest: Column, char: Column) -> Column:
        value = F.conv(char, 36, 10).cast("int")
        return (rest * F.when(value < 10, 10).otherwise(100) + value) % 97

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    if kind == "ip":
        def small(part: Column) -> Column:
            rest = F.ltrim(part, F.lit("0"))
            return (F.length(rest) <= 3) & (F.coalesce(rest.try_cast("int"), F.lit(0)) <= 255)

        return F.forall(F.split(match, "\\."), small)
    if kind == "card":
        return F.when(F.length(digits(match)).between(14, 19), luhn(digits(match))).otherwise(False)
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    if kind == "iban":
        code = F.regexp_replace(match, "\\x20", "")
        return F.length(code).between(15, 34) & mod97(code)
    return F.lit(True)


def proposals(frame: DataFrame, text: str, kind: Kind, gaps: str, hits: str) -> DataFrame:
    """Adds the pieces between matches of ``kind`` and the matches; both null where there is no match."""
    possible = F.col(text).rlike(kind.needs) if len(kind.needs) > 1 else F.contains(text, F.lit(kind.needs))
    frame = frame.withColumn(hits, F.when(possible, F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))))
    return frame.withColumn(gaps, F.when(F.size(hits) > 0, F.split(text, kind.pattern, -1))).withColumn(
        hits, F.when(F.size(hits) > 0, F.col(hits))
    )


def starts(gaps: str, hits: str) -> Column:
    """Where each match starts, in code points. Offsets are added up in blocks, so long lists stay cheap."""
    steps = F.zip_with(F.slice(gaps, F.lit(1), F.size(hits)), hits, lambda g, h: F.length(g) + F.length(h))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(hits) - 1) / _BLOCK).cast("int")),
        lambda b: F.slice(steps, b * _BLOCK + 1, F.lit(_BLOCK)),
    )

    def ends_of(base: Column, lengths: Column) -> Column:
        return F.aggregate(
            lengths,
            F.struct(base.alias("at"), F.array().cast("array<int>").alias("all")),
            lambda a, n: F.struct((a["at"] + n).alias("at"), F.array_append(a["all"], a["at"] + n).alias("all")),
        )

    def next_block(state: Column, lengths: Column) -> Column:
        done = ends_of(state["at"], lengths)
        return F.struct(done["at"].alias("at"), F.array_append(state["all"], done["all"]).alias("all"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<array<int>>").alias("all"))
    ends = F.flatten(F.aggregate(blocks, first, next_block)["all"])
    return F.zip_with(ends, hits, lambda e, h: e - F.length(h))


def found(frame: DataFrame, text: str, kind: Kind, rank: int, out: str) -> DataFrame:
    """Adds ``out``: the confirmed spans of one kind as structs (start, rank, end, kind, score), or null."""
    frame = proposals(frame, text, kind, "_gaps", "_hits").withColumn("_at", F.when(F.col("_hits").isNotNull(), starts("_gaps", "_hits")))

    spans = F.transform(
        F.filter(
            F.sequence(F.lit(0), F.size("_hits") - 1), lambda i: confirmed(kind.name, F.get("_hits", i))
        ),
        lambda i: F.struct(
            F.get("_at", i).alias("start"), F.lit(rank).alias("rank"),
            (F.get("_at", i) + F.length(F.get("_hits", i))).alias("end"), F.lit(kind.name).alias("kind"), score_of(kind, i).alias("score"),
        ),
    )
    if not kind.base:
        spans = F.filter(spans, lambda s: s["score"] >= THRESHOLD)
    return frame.withColumn(out, F.when(F.col("_hits").isNotNull(), spans)).drop("_gaps", "_hits", "_at")


def spans(docs: DataFrame, doc_id: str, text: str, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """(doc_id, base, spans) of every row: arrays of (start, rank, end, kind, score) by start, then kind.

    ``base`` holds the confirmed spans of the base kinds, ``spans`` also those of the added kinds that reach the
    threshold and do not overlap a base span.
    """
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,score:double>>")
    frame = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    for rank, kind in enumerate(kinds):
        frame = found(frame, "_text", kind, rank, f"_of{rank}")
    every = [F.coalesce(F.col(f"_of{rank}"), empty) for rank in range(len(kinds))]
    frame = frame.select(
        "doc_id",
        F.concat(*(x for x, k in zip(every, kinds) if k.base)).alias("_base"),
        F.concat(empty, *(x for x, k in zip(every, kinds) if not k.base)).alias("_more"),
    )
    apart = F.filter("_more", lambda m: ~F.exists("_base", lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"])))
    return frame.select("doc_id", F.sort_array("_base").alias("base"), F.sort_array(F.concat("_base", apart)).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def score_of(kind: Kind, i: Column) -> Column:
    """The score of match ``i``: that of its kind, raised by a context word in the pieces around it."""
    near = F.concat_ws("\n", F.right(F.get("_gaps", i), F.lit(CONTEXT)), F.left(F.get("_gaps", i + 1), F.lit(CONTEXT)))
    return F.round(F.lit(kind.score) + F.when(F.lower(near).rlike(kind.context), 0.3).otherwise(0.0), 6)


def piece(kind: Kind, i: Column) -> Column:
    """Piece ``i`` of a text and match ``i`` after it, replaced if it counts."""
    counts = F.get("_hits", i).isNotNull() & confirmed(kind.name, F.get("_hits", i))
    if not kind.base:
        counts &= score_of(kind, i) >= THRESHOLD
    shown = F.when(counts, F.lit(f"[{kind.name.upper()}]")).otherwise(F.get("_hits", i))
    return F.concat(F.get("_gaps", i), F.coalesce(shown, F.lit("")))


def redact(docs: DataFrame, text: str, kinds: tuple[Kind, ...] = KINDS) -> DataFrame:
    """The rows with confirmed personal data in ``text`` replaced by [KIND], one kind after the other.

    Matches of added kinds are replaced where they reach the threshold.
    """
    columns = docs.columns
    frame = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("_row"), F.col(text).alias("_text"))
    for kind in kinds:
        frame = proposals(frame, "_text", kind, "_gaps", "_hits")

        pieces = F.transform(F.sequence(F.lit(0), F.size("_hits")), partial(piece, kind))
        frame = frame.withColumn("_text", F.when(F.col("_hits").isNotNull(), F.array_join(pieces, "")).otherwise(F.col("_text")))
    return frame.select(*(F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in columns))
