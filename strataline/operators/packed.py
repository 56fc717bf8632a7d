"""Several values packed in one cell: one row per value, with its position.

Everything runs inside the JVM as column expressions over whole cells, so a hot cell value or a
hot key costs no more than any other row and nothing is shuffled.

The steps are those of quote-safe splitting:

1. quoted spans are replaced by indexed placeholders. The placeholder is ``U+E000 digits U+E002``;
   a working character already in the text is written as ``U+E000`` and another character, so no
   text can be mistaken for a placeholder and none is altered;
2. the rest is split at the delimiters;
3. placeholders are restored by looking their index up in the array of spans;
4. the values are exploded with their positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "\ue000", "\ue002"
#: Stands for a delimiter that was found, and for a comma that belongs to a value.
SEP, KEPT = "\ue003", "\ue004"
#: How a text's own characters of these kinds are written while the cell is worked on: OPEN and a letter of its own.
#: Every OPEN of the text is written so too, so that what follows an OPEN is never the text's.
STUFFED = {OPEN: OPEN + "\ue010", CLOSE: OPEN + "\ue012", SEP: OPEN + "\ue013", KEPT: OPEN + "\ue014"}

#: Blanks as Unicode knows them, with the separators U+001C to U+001F, for use inside a character class.
_BLANKS = r"\s\x1c-\x1f\x85   -     　"
BLANK, _WORD = f"[{_BLANKS}]", f"[^{_BLANKS},{SEP}{OPEN}]"
#: Blanks that don't delimit by themselves.
_SPACE = r"[ \x0b\x0c\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u202f\u205f\u3000]"
#: Delimiters that separate values in any kind of cell: bars, semicolons, ideographic commas, bullets, lines, tabs.
STRONG = r"|｜;；、，•·▪‣\n\r\t  "
_EDGE_BEFORE = rf"(?<![^{_BLANKS},\[{{(:{STRONG}])"
_EDGE_AFTER = rf"(?=[{_BLANKS},\]}}):{STRONG}]|$)"
QUOTED = rf"{_EDGE_BEFORE}(?:\"(?:[^\"\\]|\\.|\"\")*\"|'(?:[^'\\]|\\.|'')*'|“[^”]*”|«[^»]*»){_EDGE_AFTER}"
_END = rf"(?:[,{SEP}]|$)"
_PLACE = f"{OPEN}\\d+{CLOSE}"
#: Blanks and further delimiters behind a delimiter, and a list mark.
_REST = rf"[{_BLANKS}{STRONG}{SEP}]*+(?:[-–*]{BLANK}++)?"
#: Numbering such as "(1) ", "2) " or "3. " that opens a value.
_NUMBERED = rf"^(?:\(1\)|1[.)]){BLANK}"
_NUMBERING = rf"(?:^|(?<=[{_BLANKS}|;,]))(?:\(\d{{1,3}}\)|\d{{1,3}}[.)]){BLANK}++"
_NAMES_SPLIT = rf"{_SPACE}*+(?:[{STRONG}{SEP}]|(?<={BLANK})/(?={BLANK}|$)|/$){_REST}"
#: Blanks between classification symbols separate: the next one opens with section, class and subclass.
_CODES_SPLIT = rf"{_SPACE}*+(?:[,{STRONG}{SEP}]|(?<={BLANK})/(?={BLANK}|$)|/$)(?:,|{_REST})*+|{BLANK}++(?={OPEN}\d|[A-HY]\d\d[A-Z]{BLANK}?\d)"
#: "Surname, Given": one word before the only comma of a piece.
_INVERTED = rf"((?:^|{SEP}){_WORD}++{BLANK}*+),([^,{SEP}{OPEN}]*+)(?={SEP}|$)"
#: A comma separates names when what follows is a whole value: one that holds a quoted span, or at least two words that aren't a legal form.
_NAME_COMMA = (
    rf"{BLANK}*+,(?=[{_BLANKS}\p{{Cf}}]*+(?:{_END}|[^,{SEP}{OPEN}]*{_PLACE}[^,{SEP}]*{_END}|"
    rf"(?!(?i:company|co\.?){BLANK}+(?i:limited|ltd\.?)\b)[^{_BLANKS},\[{SEP}]++{BLANK}++[^{_BLANKS},\[{SEP}][^,{SEP}]*{_END}))[{_BLANKS},]*+"
)
_EDGES = "".join(map(chr, [*range(9, 14), *range(28, 33), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_WRAPPED = r"(?s)^(?:\[([^\[\]]*)\]|\{([^{}]*)\}|\(([^()]*)\))$"
_WRAPPED_VALUE = rf"(^|{SEP})(?:\[([^\[\]{SEP}]*)\]|\{{([^{{}}{SEP}]*)\}}|\(([^(){SEP}]*)\))(?={SEP}|$)"
#: Symbols in the usual notation need no more than a plain split.
_PLAIN_CODES = r"^[A-Z][0-9A-Z]+/[0-9]++(?:, [A-Z][0-9A-Z]+/[0-9]++)*+$"
KINDS = ("names", "codes")


def _unquote(span: Column) -> Column:
    """The text of a quoted span with escaped and doubled quotes restored."""
    quote = F.substring(span, 1, 1)
    inner = F.substring(span, F.lit(2), F.length(span) - 2)
    text = (
        F.when(quote == '"', F.regexp_replace(inner, r'\\(["\\/])|"(")', "$1$2"))
        .when(quote == "'", F.regexp_replace(inner, r"\\(['\\])|'(')", "$1$2"))
        .otherwise(inner)
    )
    return F.btrim(text, F.lit(_EDGES))


def _clean(cell: Column) -> Column:
    text = F.btrim(F.coalesce(cell, F.lit("")), F.lit(_EDGES))
    safe = text
    for own, written in STUFFED.items():  # OPEN first
        safe = F.replace(safe, F.lit(own), F.lit(written))
    return F.when(text.rlike(f"[{''.join(STUFFED)}]"), safe).otherwise(text)


def _restored(value: Column) -> Column:
    for own, written in reversed(STUFFED.items()):  # OPEN last
        value = F.replace(value, F.lit(written), F.lit(own))
    return value


def with_packed_values(df: DataFrame, cell: str, kind: str, to: str) -> DataFrame:
    """``df`` with the values of column ``cell`` as ``array<string>`` in column ``to``.

    Column ``kind`` holds ``names`` (persons and organisations: a comma separates only whole
    names) or ``codes`` (classification symbols: blanks and commas separate too). Values are in
    order, empty ones are left out, repeated ones stay. A null, empty or blank cell gives an
    empty array.
    """
    c, names = F.col, F.col(kind) == "names"
    # Each step is a column of its own: it is computed once, however often the next ones use it.
    df = df.withColumn("__text", _clean(c(cell)))
    df = df.withColumn("__plain", ~names & c("__text").rlike(_PLAIN_CODES))
    quoted = ~c("__plain") & c("__text").rlike(_EDGE_BEFORE + "[\"'“«]")
    df = df.withColumn("__spans", F.when(quoted, F.regexp_extract_all(c("__text"), F.lit(QUOTED), F.lit(0))))
    df = df.withColumn("__around", F.when(F.size("__spans") > 0, F.split(F.regexp_replace(c("__text"), QUOTED, SEP), SEP, -1)))
    df = df.withColumn(
        "__marked",
        F.when(
            c("__around").isNotNull(),
            F.array_join(F.transform("__around", lambda piece, i: F.when(i == 0, piece).otherwise(F.concat(F.lit(OPEN), (i - 1).cast("string"), F.lit(CLOSE), piece))), ""),
        ).otherwise(c("__text")),
    )
    bare = F.when(
        c("__marked").rlike(_WRAPPED), F.btrim(F.substring(c("__marked"), F.lit(2), F.length(c("__marked")) - 2), F.lit(_EDGES))
    ).otherwise(c("__marked"))
    df = df.withColumn("__bare", F.regexp_replace(bare, rf"^[-–*•▪‣]{BLANK}++", ""))
    df = df.withColumn("__bare", F.when(c("__bare").rlike(_NUMBERED), F.regexp_replace("__bare", _NUMBERING, SEP)).otherwise(c("__bare")))
    df = df.withColumn(
        "__cut",
        F.when(c("__plain"), F.replace(c("__bare"), F.lit(", "), F.lit(SEP)))
        .when(names, F.regexp_replace("__bare", _NAMES_SPLIT, SEP))
        .otherwise(F.regexp_replace("__bare", _CODES_SPLIT, SEP)),
    )
    in_names = F.translate(F.regexp_replace(F.regexp_replace("__cut", _INVERTED, f"$1{KEPT}$2"), _NAME_COMMA, SEP), KEPT, ",")
    df = df.withColumn("__cut", F.btrim(F.when(names & c("__cut").contains(","), in_names).otherwise(c("__cut")), F.lit(SEP + " ")))
    wrapped = c("__cut").contains("[") | c("__cut").contains("{") | c("__cut").contains("(")
    df = df.withColumn("__cut", F.when(wrapped, F.regexp_replace(c("__cut"), _WRAPPED_VALUE, "$1$2$3$4")).otherwise(c("__cut")))
    df = df.withColumn("__parts", F.when(c("__cut") == "", F.array().cast("array<string>")).otherwise(F.split("__cut", SEP, -1)))

    def restore(part: Column) -> Column:
        at = F.regexp_extract_all(part, F.lit(f"{OPEN}(\\d+){CLOSE}"), F.lit(1))
        inside = F.array_join(
            F.transform(F.split(part, _PLACE, -1), lambda x, i: F.concat(x, F.coalesce(F.get(c("__spans"), F.get(at, i).cast("int")), F.lit("")))), ""
        )
        value = F.when(part.rlike(f"^{_PLACE}$"), _unquote(F.get(c("__spans"), F.get(at, F.lit(0)).cast("int")))).when(part.rlike(_PLACE), inside).otherwise(part)
        return _restored(value)

    values = F.when(c("__cut").contains(OPEN), F.filter(F.transform("__parts", restore), lambda v: ~v.rlike(r"^[\p{Z}\s]*$"))).otherwise(c("__parts"))
    return df.withColumn(to, values).drop("__text", "__spans", "__around", "__marked", "__bare", "__cut", "__parts", "__plain")


def explode_packed(df: DataFrame, keys: list[str], fields: dict[str, str], least: int = 2) -> DataFrame:
    """One row per value of every packed cell: ``keys``, ``field``, ``pos`` (from 1), ``val``.

    ``fields`` gives the kind of each column, see :func:`with_packed_values`; cells of fewer than
    ``least`` values are left out. Null, empty and blank cells have no rows; repeated rows each
    give their own; other columns of ``df`` are ignored, whatever their names. An empty table
    gives an empty result of the same schema.
    """
    for name, kind in fields.items():
        if kind not in KINDS:
            raise ValueError(f"unknown kind of packed cell: {name}: {kind}")
    cells = [
        F.when(F.length(F.col(f"`{name}`")) > least, F.struct(F.lit(name).alias("field"), F.lit(kind).alias("kind"), F.col(f"`{name}`").alias("cell"))) for name, kind in fields.items()
    ]
    own = [F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)]
    rows = df.select(*own, F.explode(F.array_compact(F.array(*cells))).alias("__c"))
    rows = rows.select(*[f"__k{i}" for i in range(len(keys))], "__c.*")
    rows = with_packed_values(rows, "cell", "kind", "__vals")
    back = [F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)]
    rows = rows.select(*[f"__k{i}" for i in range(len(keys))], "field", F.posexplode(F.when(F.size("__vals") >= least, F.col("__vals"))).alias("__p", "val"))
    return rows.select(*back, "field", (F.col("__p") + 1).cast("int").alias("pos"), "val")
