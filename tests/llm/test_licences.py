import textwrap

from pyspark.sql import functions as F

from tidemark.llm import licences, queries
from tidemark.llm.licences import learn, licence_paragraphs

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."""
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"
AGPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
ISC = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
ODD = "The Harbour Public License covers this work.\nYou may sail it, but not sell it."


def wrapped(text, start=""):
    return "\n".join(line for part in text.split("\n\n") for line in ["", *textwrap.wrap(part, 72, initial_indent=start, subsequent_indent=start)])


def test_wrapped_and_full_texts(documents, rows_of):
    plain = [f"The ferry number {k} leaves the old harbour at noon\nand returns with the tide, with all permission of the port." for k in range(60)]
    docs = documents(
        *enumerate(plain), (100, f"Copyright 2020 Somebody\n{wrapped(MIT)}"), (101, MIT.replace("\n\n", " ")), (102, "A title\n\n" + wrapped(BSD, " * ").strip("\n") + "\n\nmore"),
        (103, wrapped(AGPL, "# ")), (104, wrapped(ISC)), (105, "First words.\n\n" + ODD), (None, wrapped(BSD)), (106, "Some words.\nReleased under the MIT License.\nMore."),
    )
    found = licence_paragraphs(docs, learn(docs))
    assert rows_of(found.where("confirmed"), "doc_id", "paragraph", "last", "family") == sorted(
        [
            (100, 2, 8, "MIT"), (101, 0, 0, "MIT"), (102, 2, 4, "BSD"), (103, 1, 4, "AGPL"), (104, 1, 3, "ISC"), (None, 1, 3, "BSD"), (106, 1, 1, "MIT"),
        ],
        key=repr,
    )
    assert rows_of(found.where("family = 'unknown' and doc_id = 105"), "paragraph", "last", "confirmed") == [(2, 3, False)]
    assert found.where("doc_id < 60").count() == 0


def test_own_notices_need_no_customary_word(documents, rows_of):
    own = {"Harbour": ["May everyone sail this work on any tide without asking the harbour master first."], "Pier": ["Take it to the pier and back."]}
    plain = [f"The ferry number {k} leaves the old quay at noon\nand returns with the wind." for k in range(60)]
    docs = documents(
        *enumerate(plain), (100, "A title\n\nMay everyone sail this work on any tide\nwithout asking the harbour master first.\n\nmore"),
        (101, "May everyone sail this work on any tide without asking the HARBOUR\nmaster first. And more words follow here."), (102, "Go and take it to\nthe pier and back."),
        (103, "The harbour master is first."), (104, ""), (105, None),
    )
    found = licence_paragraphs(docs, learn(docs, own), own)
    assert rows_of(found.where("confirmed"), "doc_id", "paragraph", "last", "family") == [(100, 2, 3, "Harbour"), (101, 0, 1, "Harbour"), (102, 0, 1, "Pier")]


def test_every_document_teaches(documents, spark, rows_of):
    """The paragraphs that share words with a notice stand in the documents whose hashes are the largest."""
    own = {"Pier": ["Take it to the pier and back."]}
    ids = [r[0] for r in spark.range(600).selectExpr("id", "xxhash64(id) as h").orderBy("h", "id").collect()]
    far = "We take the ferry {} to the pier and come back by noon with it while gulls sail over many boats which carry salt fish wine wool from far islands"
    docs = documents(*((k, far.format(k) if n >= 420 else f"Number {k} leaves at noon\nand returns with wind.") for n, k in enumerate(ids)), (600, "Take it to the pier and back."))
    found = licence_paragraphs(docs, learn(docs, own), own)
    assert rows_of(found, "doc_id", "family", "confirmed") == [(600, "Pier", True)]


def test_no_documents(documents):
    docs = documents("a").where("false")
    assert licence_paragraphs(docs, learn(docs)).count() == 0


def test_query_cuts_texts_into_words_once(documents, spark, rows_of, monkeypatch):
    """Three passes over the texts: words of lines, lines found, runs; only the first cuts all lines into words."""
    reads = spark.sparkContext.accumulator(0)

    def read(text):
        reads.add(1)
        return text

    plain = [f"The ferry number {k} leaves the old harbour at noon\nand returns with the tide, with all permission of the port." for k in range(40)]
    docs = documents(*plain, "Some words.\nReleased under the MIT License.\nMORE.", "===\n123\n\n" + wrapped(BSD), "", None)
    alone = licence_paragraphs(docs, learn(docs))
    counted = docs.withColumn("text", F.udf(read, "string").asNondeterministic()("text"))
    monkeypatch.setattr(queries, "_table", lambda *args: counted)
    found = rows_of(queries.QUERIES["op7_licences"](spark, ""), "doc_id", "paragraph", "last", "family", "confirmed")
    assert reads.value <= 3 * len(plain) + 12
    assert found == rows_of(alone, "doc_id", "paragraph", "last", "family", "confirmed")
    assert [(d, f) for d, *_, f, sure in found if sure] == [(40, "MIT"), (41, "BSD")]


def test_long_rules_between_words(documents, rows_of):
    """Lines of marks are as long as they like."""
    docs = documents("A title\n" + "=" * 50_000 + "\n" + "a.b" * 30_000 + "\n\nReleased under the MIT License. " + "- " * 30_000, "Other words.")
    found = licence_paragraphs(docs, learn(docs))
    assert (0, 4, 4, "MIT", True) in rows_of(found, "doc_id", "paragraph", "last", "family", "confirmed")


def test_words_as_split_at_all_else(spark):
    lines = ["V. 2.0. is.a._b a..b .net 3.", "BSD-style c++ é.É ÀÉ.x K \u0130I straße.", "", "...", "a\u00a0b \U0001d400.x x.\U0001d400", "tab\there\r", "Copyright (c) 2020.\r"]
    table = spark.createDataFrame([(t,) for t in [*lines, None]], "line string")
    low = F.translate("line", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = F.array_remove(F.split(low, r"(?:[^\p{L}\p{N}.+-]|[.](?=\W|$))+"), "")
    assert table.where(~licences._words("line").eqNullSafe(split)).collect() == []


def test_texts_left_out_before_the_pattern_cannot_match(documents, spark):
    says = ["LICENSED UNDER x", "a public licence", "licence agreement", "Under the terms of this odd Licence", "RIGHTS RESERVED", "permission is granted", "Permission to use a thing granted",
            "permission to use, copy", "Redistribution and use", "may be Redistributed", "may be freely redistributed", "public\nDomain"]
    own = {"Übung": ["Ünder ÜBUNG Éclat"], "Pier": ["Take it to the PIER and back."]}
    docs = documents(*says, "ÜNDER", "so ünder Übung", "so Ünder", "to the Pier", "nothing of it")
    pieces, needed = licences._needed(spark, own)
    met = {r[0] for r in docs.where(F.translate("text", "\n", " ").rlike(needed)).select("doc_id").collect()}
    assert met >= set(range(len(says)))
    assert met == {r[0] for r in licences._runs(docs, pieces, needed, "doc_id").select("doc_id").collect()}
