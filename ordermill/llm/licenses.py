"""Licence scans: known licence sentences become identifiers, and ordered rules read the identifiers' sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .frames import column

#: Licence sentences in normal form (see ``normal``) and their identifiers.
SENTENCES = {
    "all rights reserved": "reserved",
    "licensed under the apache license version 2 0": "apache2",
    "licensed under the apache license version 2 0 the license": "apache2",
    "you may not use this file except in compliance with the license": "apache2comply",
    "you may obtain a copy of the license at": "apache2copy",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis": "apache2asis",
    "see the license for the specific language governing permissions and limitations under the license": "apache2see",
    "spdx license identifier apache 2 0": "apache2",
    "released under the mit license": "mit",
    "licensed under the mit license": "mit",
    "this project is licensed under the mit license": "mit",
    "spdx license identifier mit": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mitgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mitnotice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsdgrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsdsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsdbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsdnames",
    "spdx license identifier bsd 3 clause": "bsd3",
    "spdx license identifier bsd 2 clause": "bsd2",
    "this work is licensed under the gnu general public license version 3": "gpl3",
    "this work is licensed under the gnu general public license version 2": "gpl2",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2",
    "spdx license identifier gpl 3 0 only": "gpl3",
    "spdx license identifier gpl 3 0 or later": "gpl3",
    "licensed under the mozilla public license version 2 0": "mpl2",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2",
    "licensed under cc by 4 0": "ccby4",
    "licensed under cc by sa 4 0": "ccbysa4",
    "licensed under cc by nc 4 0": "ccbync4",
    "licensed under cc by nd 4 0": "ccbynd4",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4",
    "this work is dedicated to the public domain": "publicdomain",
    "released into the public domain": "publicdomain",
}
#: Sentences that the originals run together on one line or go on with, and the identifiers they stand for.
#: They are looked up by ``scan`` only.
_ASIS = "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"
_WARRANTY = f"{_ASIS} without warranties or conditions of any kind either express or implied"
_BY_ID = {identifier: sentence for sentence, identifier in SENTENCES.items()}
JOINED = {
    f"licensed under the apache license version 2 0 the license {_BY_ID['apache2comply']}": "apache2;apache2comply",
    _WARRANTY: "apache2asis",
    **{f"{_BY_ID['apache2copy']} {site} www apache org licenses license 2 0{rest}": ids
       for site in ("http", "https") for rest, ids in (("", "apache2copy"), (f" {_ASIS}", "apache2copy;apache2asis"), (f" {_WARRANTY}", "apache2copy;apache2asis"))},
    f"{_BY_ID['mitgrant']} {_BY_ID['mitnotice']}": "mitgrant;mitnotice",
    f"{_BY_ID['bsdgrant']} 1": "bsdgrant",
    f"{_BY_ID['bsdgrant']} {_BY_ID['bsdsource']}": "bsdgrant;bsdsource",
}
#: Ordered rules (pattern over the identifiers, each followed by a semicolon; licence; whether it permits reuse).
#: A rule takes what it matches out of the sequence, so longer forms stand before the forms they contain.
RULES = (
    ("apache2;(?:apache2comply;)?(?:apache2copy;)?(?:apache2asis;)?(?:apache2see;)?", "Apache-2.0", True),
    ("apache2comply;apache2copy;(?:apache2asis;)?(?:apache2see;)?", "Apache-2.0", True),
    ("(?:mit;)?mitgrant;(?:mitnotice;)?", "MIT", True),
    ("mit;", "MIT", True),
    ("bsdgrant;bsdsource;bsdbinary;bsdnames;", "BSD-3-Clause", True),
    ("bsdgrant;bsdsource;bsdbinary;", "BSD-2-Clause", True),
    ("bsd3;", "BSD-3-Clause", True),
    ("bsd2;", "BSD-2-Clause", True),
    ("gpl3;", "GPL-3.0", False),
    ("gpl2;", "GPL-2.0", False),
    ("mpl2;", "MPL-2.0", True),
    ("ccbync4;", "CC-BY-NC-4.0", False),
    ("ccbynd4;", "CC-BY-ND-4.0", False),
    ("ccbysa4;", "CC-BY-SA-4.0", True),
    ("ccby4;", "CC-BY-4.0", True),
    ("publicdomain;", "public-domain", True),
    ("reserved;", "all-rights-reserved", False),
)
#: A sentence ends at a blank line, and after . ! or ? before white space, but not between "v." and a number. It may also end
#: at any other line's end, but need not.
ENDS = r"\n[\x20\x09-\x0D]*\n|(?<=[.!?])(?<!\b[vV]\.(?=[\x20\x09-\x0D]{1,9}[0-9]))[\x20\x09-\x0D]+"
#: Text without any of these words has no known sentence. Single words, as any run of other characters may stand between two. Fixed values.
HINT = "(?i)licen[cs]e|reserved|redistribut|granted|notice|domain|endorse"


def normal(sentence: Column) -> Column:
    """Lower case, every run of other characters than ASCII letters and digits one blank, none at the ends."""
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9]+", " "))


def sequence_of(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order, each followed by a semicolon.

    Of the known sentences that begin at a line the longest counts, so a wrapped one comes before those within its lines.
    """
    sentences = SENTENCES | JOINED
    known = F.create_map(*(F.lit(x) for pair in sentences.items() for x in pair))
    longest = "|".join(s.replace(" ", "[ \n]") for s in sorted(sentences, key=len, reverse=True))
    # only stretches with a hint are normalised, line by line, and searched
    hinted = F.filter(F.split(text, ENDS, -1), lambda s: s.rlike(HINT))
    lines = lambda s: F.array_join(F.filter(F.transform(F.split(s, "\n", -1), normal), lambda x: x != ""), "\n")
    found = F.regexp_extract_all(F.array_join(F.transform(hinted, lines), "\n\n"), F.lit(rf"(?<![^\n])(?:{longest})(?![^\n])"), F.lit(0))
    ids = F.transform(found, lambda s: F.concat(F.element_at(known, F.translate(s, "\n", " ")), F.lit(";")))
    return F.when(text.rlike(HINT), F.array_join(ids, "")).otherwise("")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, licences (names, comma between, in rule order), permissive and sentences for each row of ``docs`` with a known sentence.

    ``sentences`` is the sequence of identifiers; ``licences`` is empty where no rule reads it; ``permissive`` says that
    there is a licence and all found permit reuse. The rules are tried in their order; each takes all its matches out of
    the sequence, so every known sentence counts for one licence.

    Null and empty texts have no sentences and no row. Null and repeated ids are read row by row; an empty table gives an
    empty result; other columns are ignored, whatever their names. Each row is read by itself: nothing is shuffled.
    """
    text = F.coalesce(column(text_col).cast("string"), F.lit(""))
    rows = docs.select(column(id_col).alias("doc_id"), sequence_of(text).alias("sentences")).where("sentences <> ''")
    left = F.col("sentences")
    rows = rows.withColumn("left0", left)
    for k, (pattern, _, _) in enumerate(RULES):
        rows = rows.withColumn(f"left{k + 1}", F.regexp_replace(f"left{k}", pattern, ""))
    found = [F.when(F.col(f"left{k}") != F.col(f"left{k + 1}"), F.struct(F.lit(name).alias("name"), F.lit(free).alias("free"))) for k, (_, name, free) in enumerate(RULES)]
    rows = rows.withColumn("found", F.array_compact(F.array(*found)))
    return rows.select("doc_id", F.array_join(F.array_distinct("found.name"), ",").alias("licences"),
                       ((F.size("found") > 0) & F.forall("found", lambda x: x["free"])).alias("permissive"), "sentences")


def scan_sql(table: str = "documents") -> str:
    """DuckDB SQL with the rows of ``scan`` for texts whose known sentences each stand on one line; it does not know ``JOINED``."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    known = ", ".join(f"({quote(s)}, {quote(i)})" for s, i in SENTENCES.items())
    steps, before = [], "sequences"
    for k, (pattern, name, free) in enumerate(RULES):
        steps.append(f"step{k} AS (SELECT doc_id, sentences, regexp_replace(rest, {quote(pattern)}, '', 'g') AS rest, "
                     f"CASE WHEN regexp_matches(rest, {quote(pattern)}) AND NOT list_contains(names, {quote(name)}) THEN list_append(names, {quote(name)}) ELSE names END AS names, "
                     f"free AND ({'true' if free else 'false'} OR NOT regexp_matches(rest, {quote(pattern)})) AS free FROM {before})")
        before = f"step{k}"
    return f"""
        WITH known(sentence, id) AS (VALUES {known}),
        cut AS (SELECT doc_id, rowid_ AS n, generate_subscripts(parts, 1) AS place, unnest(parts) AS part
                FROM (SELECT doc_id, row_number() OVER () AS rowid_,
                             string_split(regexp_replace(text, '([.!?])[\\x20\\x09-\\x0D]+', '\\1' || chr(10), 'g'), chr(10)) AS parts FROM {table})),
        sequences AS (SELECT any_value(doc_id) AS doc_id, string_agg(id || ';', '' ORDER BY place) AS sentences,
                             string_agg(id || ';', '' ORDER BY place) AS rest, []::VARCHAR[] AS names, true AS free
                      FROM cut JOIN known ON known.sentence = trim(regexp_replace(lower(part), '[^a-z0-9]+', ' ', 'g')) GROUP BY n),
        {", ".join(steps)}
        SELECT doc_id, array_to_string(names, ',') AS licences, (len(names) > 0 AND free) AS permissive, sentences FROM {before}"""
