"""Collections of SQL scripts: statements, their kinds, and procedure calls."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tidemark.functions.scalars import split_args, unescape_sql_string

# What the script dialects add to ``--`` comments, quoted text
# and the ``;`` terminator.
DIALECTS = {
    "plain": {},
    "timeplus": {"slash_comments": True, "dollar_quotes": True},
    "ignite": {"dollar_quotes": True},
    "db2z": {"blocks": True, "directives": True},
}
BLOCK_WORDS = ["LOOP", "CASE", "DO", "REPEAT", "IF"]
DDL_WORDS = ["CREATE", "ALTER", "DROP"]
GUARD_WORDS = ["ROW", "EACH", "CREATE", "DROP", "NOT", "EXISTS"]
TERMINATOR_DIRECTIVE = "--#SET TERMINATOR "

# Patterns of script text. Every repetition is possessive: one pass, no recursion.
TOLD = TERMINATOR_DIRECTIVE + r"[^\r\n]*+"
LINE_COMMENT = r"--[^\r\n]*+"
SLASH_COMMENT = r"//[^\r\n]*+"
BLOCK_COMMENT = r"/\*(?s:.*?)\*/"
QUOTED = r"'[^']*+'|\"[^\"]*+\"|`[^`]*+`"
DOLLAR_QUOTED = r"\$([A-Za-z0-9_]*+)\$(?s:.*?)\$\1\$"
WORD = r"[A-Za-z_][A-Za-z0-9_]*+"
OPENERS = {"BEGIN", *BLOCK_WORDS}
MARKS = ["BEGIN", "END", *BLOCK_WORDS, *GUARD_WORDS]
INITIALS = "".join(sorted({w[0] for w in MARKS}))
BLOCK_WORD = rf"(?=[{INITIALS}{INITIALS.lower()}])(?i:{'|'.join(MARKS)})(?![A-Za-z0-9_])"
PLAIN_RUN = r"[0-9(),.=<>+*:]++"
TEXT_RUN = r"[^'\"`$;/-]++"
ANY = r"(?s:.)"
END = r"\Z"
#: Characters of statements that leave a task at once.
BATCH = 1 << 22


def _patterns(rules: dict) -> tuple[str, str, str]:
    """Patterns of silence (spaces, comments), of text and of what ends text.

    Text ends at a mark: a character that may be the terminator, a word that
    may change the block depth, a directive, or the end of the script.
    """
    line = rf"(?!{TERMINATOR_DIRECTIVE}){LINE_COMMENT}" if rules.get("directives") else LINE_COMMENT
    silent = [r"[ \t-\r]++", line, BLOCK_COMMENT]
    if rules.get("slash_comments"):
        silent.append(SLASH_COMMENT)
    text = [*silent, QUOTED]
    if rules.get("dollar_quotes"):
        text.append(DOLLAR_QUOTED)
    if rules.get("blocks"):
        text += [f"(?!{BLOCK_WORD}){WORD}", PLAIN_RUN]
        mark = [TOLD, BLOCK_WORD, ANY, END]
    else:
        text += [TEXT_RUN, "[^;]"]
        mark = [";", END]
    return f"(?:{'|'.join(silent)})*+", f"(?:{'|'.join(text)})*+", f"(?:{'|'.join(mark)})"


def _depth_change(words: list[str], alone: Callable[[int], bool], i: int) -> int:
    """How mark ``i`` changes the block depth; ``words`` are the marks in capitals."""
    word, before = words[i], words[i - 1] if i else ""
    if word == "END":
        return 0 if before == "ROW" and alone(i) else -1
    if word not in OPENERS or before == "END" and alone(i):
        return 0
    if word == "BEGIN" and before == "ROW" and i > 1 and words[i - 2] != "EACH" and alone(i):
        return 0
    if word == "IF" and before in ("CREATE", "DROP"):
        at = i + 2 if words[i + 1] == "NOT" and alone(i + 1) else i + 1
        if words[at] == "EXISTS" and alone(at):  # the last mark is no word
            return 0
    return 1


def _statements(text: str, rules: dict, piece: re.Pattern, silence: re.Pattern) -> Iterator[str]:
    """The statements of one script: a pass along its marks keeps the terminator in force and the block depth."""
    spans = [(found.start(), found.start(piece.groups), found.end()) for found in piece.finditer(text)]
    marks = [text[start:end] for _, start, end in spans]

    def alone(i: int) -> bool:
        """Whether only silence separates a mark from the one before."""
        at, start, _ = spans[i]
        return start == at or silence.fullmatch(text, at, start) is not None

    words = [mark.upper() for mark in marks] if rules.get("blocks") else []
    terminator, depth, low, parts = ";", 0, 0, []
    for i, ((at, start, end), mark) in enumerate(zip(spans, marks)):
        says = mark != ""
        if len(mark) > 1 and mark.startswith(TERMINATOR_DIRECTIVE):
            terminator, says = mark[len(TERMINATOR_DIRECTIVE) :].strip(" "), False
        elif len(mark) > 1 and words:
            depth += _depth_change(words, alone, i)
            # A stray END does not count: depth is measured from its lowest point.
            low = min(low, depth)
        if not says and alone(i):
            continue
        if mark != terminator or depth != low:
            parts.append(text[at : end if says else start])
        elif parts or not alone(i):  # a terminator with nothing before it ends nothing
            yield "".join([*parts, text[at:start]])
            parts = []
    if parts:
        yield "".join(parts)


def split_statements(scripts: DataFrame, dialect: str = "plain", path: str = "path") -> DataFrame:
    """One row ``(path, stmt_no, sql)`` per statement of each script.

    A script is cut at its marks, see ``_patterns``; everything else travels
    with the mark after it. One pass along the marks finds the terminator in
    force, the block depth and the end of each statement, so only scripts are
    dealt to the tasks and never their many pieces. A terminator is one character
    and ends a statement outside blocks only. Comments inside a statement stay,
    comments before it go. ``path`` is unique.
    """
    rules = DIALECTS[dialect]
    silence, text, mark = _patterns(rules)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Words and spaces of scripts are those of ASCII.
        piece, silent = re.compile(f"{text}({mark})", re.ASCII), re.compile(silence, re.ASCII)

        def table(paths: pa.Array, rows: list[int], numbers: list[int], sqls: list[str]) -> pa.RecordBatch:
            columns = [paths.take(pa.array(rows, pa.int64())), pa.array(numbers, pa.int32()), pa.array(sqls, pa.string())]
            return pa.RecordBatch.from_arrays(columns, [path, "stmt_no", "sql"])

        for batch in batches:
            paths, rows, numbers, sqls, size = batch.column(path), [], [], [], 0
            for row, script in enumerate(batch.column("text")):
                for number, sql in enumerate(_statements(script.as_py() or "", rules, piece, silent), 1):
                    rows.append(row)
                    numbers.append(number)
                    sqls.append(sql[silent.match(sql).end() :].strip(" \t\r\n"))
                    size += len(sql)
                    if size > BATCH:
                        yield table(paths, rows, numbers, sqls)
                        rows, numbers, sqls, size = [], [], [], 0
            if rows:
                yield table(paths, rows, numbers, sqls)

    # The number of tasks is fixed: scripts are small before they are cut.
    tasks = int(scripts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([scripts.schema[path], StructField("stmt_no", IntegerType()), StructField("sql", StringType())])
    return scripts.select(path, F.col("text").cast("string").alias("text")).repartition(tasks, path).mapInArrow(cut, schema)


def _bare(sql: Column) -> Column:
    """Statement without quoted text and comments."""
    pattern = "|".join([LINE_COMMENT, BLOCK_COMMENT, QUOTED, DOLLAR_QUOTED])
    return F.regexp_replace(sql, pattern, " ")


def classify_statements(statements: DataFrame) -> DataFrame:
    """Add the first word as kind, and whether the statement may run in a
    transaction: it has no CREATE, ALTER or DROP word outside quoted text."""
    bare = F.upper(_bare(F.col("sql")))
    kind = F.regexp_extract(bare, r"[A-Z_]++", 0)
    ddl = bare.rlike(r"(?<![A-Z0-9_$#@])(" + "|".join(DDL_WORDS) + r")(?![A-Z0-9_$#@])")
    return statements.withColumns({"kind": kind, "transactional": ~ddl})


#: A procedure is plain or quoted parts joined by dots; its arguments may be left out.
PART = r"(?:[^\s().\"`]++|\"[^\"]*+\"|`[^`]*+`)"
CALL = rf"(?is)\A\s*+CALL\s++({PART}(?:\.{PART})*+)\s*+(?:\((.*)\)\s*+)?+\z"
COMMENT = rf"{LINE_COMMENT}|{BLOCK_COMMENT}"
LITERAL = r"'[^']*+'|\"[^\"]*+\"|`[^`]*+`|" + DOLLAR_QUOTED


def _uncommented(sql: Column) -> Column:
    """Statement with a space for each comment; quoted text stays as it is."""
    pieces = F.regexp_extract_all(sql, F.lit(rf"{LITERAL}|{COMMENT}|[^'\"`$/-]++|{ANY}"), F.lit(0))
    plain = F.array_join(F.transform(pieces, lambda p: F.when(p.rlike(rf"^(?:{COMMENT})\z"), " ").otherwise(p)), "")
    return F.when(F.contains(sql, F.lit("--")) | F.contains(sql, F.lit("/*")), plain).otherwise(sql)  # most have none


def extract_calls(statements: DataFrame, path: str = "path", bare: bool = False) -> DataFrame:
    """One row per argument of each CALL, with the argument's kind and value.

    Kinds: ``string`` (unescaped), ``int``, ``null``, and ``raw`` for any other
    text, a number beyond 32 bits included. Comments outside quoted text do not
    count. With ``bare`` a call without arguments, with or without brackets, has
    one row, whose arg_no, kind and values are null; else it has none.
    """
    found = statements.filter(F.col("sql").rlike("(?i)CALL")).withColumn("sql", _uncommented(F.col("sql")))
    found = found.filter(F.col("sql").rlike(CALL))
    args = F.trim(F.regexp_extract("sql", CALL, 2), F.lit(" \t\r\n\f\v"))
    found = found if bare else found.filter(args != "")
    calls = found.select(
        path,
        "stmt_no",
        F.regexp_extract("sql", CALL, 1).alias("procedure"),
        F.posexplode_outer(F.when(args != "", split_args(args))).alias("arg_no", "arg"),
    )
    arg = F.col("arg")
    number = F.when(arg.rlike(r"^-?[0-9]+$"), arg.try_cast("int"))
    kind = (
        F.when(arg.rlike(r"^(?s)'.*'$"), "string")
        .when(number.isNotNull(), "int")
        .when(F.upper(arg) == "NULL", "null")
        .when(arg.isNotNull(), "raw")
    )
    return calls.withColumn("kind", kind).select(
        path,
        "stmt_no",
        "procedure",
        (F.col("arg_no") + 1).alias("arg_no"),
        "kind",
        F.when(F.col("kind") == "string", unescape_sql_string(arg))
        .when(F.col("kind") == "raw", arg)
        .alias("str_value"),
        F.when(F.col("kind") == "int", number).alias("int_value"),
    )
