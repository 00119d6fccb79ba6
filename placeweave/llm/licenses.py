"""Licence scans by sentence rules.

A text is cut into sentences, each sentence normalised (ASCII letters and
digits in lower case, single blanks) and mapped to the identifier of a known
licence sentence. The identifiers of a text, in order, form its sequence;
sentences that aren't known leave no trace in it. A licence rule is an ordered
list of identifiers and matches where they stand next to each other in the
sequence. A rule that is part of a longer one gives way to it.

A line break ends a sentence unless the next line goes on in lower case, so
licence texts may be wrapped. All of it is column expressions on one row: no
shuffle, whatever the source of a document holds.

Licence texts of several sentences are also looked for as runs of words in the
whole text, whatever its line breaks, indents, comment marks, list marks and
capitals; ``licences`` has what either way finds, and MIT for its title on a line
of its own. Counts and sequence are those of the sentences as cut above, and so
is the SQL, which doesn't know the runs or the title.

Defined cases: null and empty texts have no sentences and no licences; repeated
rows are scanned alike; an empty table gives an empty table; a sentence that is
repeated is in the sequence as often.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeweave.llm.texts import bind

# Normalised licence sentences, as their licences word them.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-notice-2": "licensed under the mit license",
    "mit-title": "mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-keep": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-grant": "licensed under the apache license version 2 0 the license",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-free-2": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "cc-by-nc4-notice": "licensed under cc by nc 4 0",
    "cc-by4-notice": "licensed under cc by 4 0",
    "cc-by-sa4-notice": "licensed under cc by sa 4 0",
    "cc0-notice": "licensed under cc0 1 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-bsd3": "spdx license identifier bsd 3 clause",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
}

# Rule: (licence, identifiers in order). Longer rules that contain another one
# take its place.
RULES = [
    ("MIT", ("mit-notice",)),
    ("MIT", ("mit-notice-2",)),
    ("MIT", ("mit-grant", "mit-keep", "mit-as-is")),
    ("MIT", ("spdx-mit",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-grant", "apache-comply", "apache-copy", "apache-as-is")),
    ("Apache-2.0", ("spdx-apache",)),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-3-Clause", ("spdx-bsd3",)),
    ("GPL-3.0", ("gpl3-notice",)),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")),
    ("GPL-3.0-or-later", ("spdx-gpl3",)),
    ("GPL-2.0-or-later", ("gpl-free-2", "gpl-hope")),
    ("CC-BY-NC-4.0", ("cc-by-nc4-notice",)),
    ("CC-BY-4.0", ("cc-by4-notice",)),
    ("CC-BY-SA-4.0", ("cc-by-sa4-notice",)),
    ("CC0-1.0", ("cc0-notice",)),
]

# Beyond the sequence: licence texts in any layout (wrapped, indented, commented,
# with list marks), found as runs of words. Wordings that sentences don't give:
RUNS = {
    "apache-grant-asf": "licenses this file to you under the apache license version 2 0 the license",
    "apache-copy-https": "you may obtain a copy of the license at https www apache org licenses license 2 0",
    "mit-as-is-2": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and non infringement",
}
SAME_AS = {
    "apache-grant-asf": "apache-grant",
    "apache-copy-https": "apache-copy",
    "mit-as-is-2": "mit-as-is",
}
TITLE_RULE = ("MIT", "|mit-title|")
COMMENT_WORD = "(?im)^[\\x20\\x09]*(?:dnl|rem|c)(?=[\\x20\\x09])"
NAMED = "neither the name of (?:[a-z0-9]+ ){1,16}?nor the names of its contributors "
NAMED_AS = "neither the name of the copyright holder nor the names of its contributors "

BREAK = "\x01"
# Three passes, the same ones in the SQL below: ends of sentences, line breaks
# that don't go on in lower case, then everything but letters and digits.
# A full stop inside a sentence's own punctuation (semicolon, colon) doesn't end
# it, as licence sentences use both.
SENTENCE_END = "[.!?]+([\\x20\\x09-\\x0D]|$)"
LINE_END = "\\n([^a-z]|$)"
NOT_PLAIN = "[^A-Za-z0-9\\x01]+"


def sentences(text: Column) -> Column:
    """Normalised sentences of a text, none empty."""
    marked = F.regexp_replace(F.coalesce(text, F.lit("")), SENTENCE_END, BREAK + "$1")
    marked = F.regexp_replace(marked, LINE_END, BREAK + "$1")
    plain = F.lower(F.regexp_replace(marked, NOT_PLAIN, " "))
    return F.filter(F.transform(F.split(plain, BREAK), lambda s: F.btrim(s)), lambda s: s != "")


def _known(found: Column) -> Column:
    """Identifiers of the known sentences, in order, as ``|a|b|``."""
    table = F.create_map(*[F.lit(v) for v in chain(*((s, i) for i, s in SENTENCES.items()))])
    longest = max(map(len, SENTENCES.values()))
    shortest = min(map(len, SENTENCES.values()))
    fitting = F.filter(found, lambda s: F.length(s).between(shortest, longest))
    ids = F.transform(fitting, lambda s: F.try_element_at(table, s))
    return F.array_compact(ids)


def _run_sequence(text: Column) -> Column:
    """Identifiers of the long licence sentences (those of rules of more than one)
    found as runs of words, in order, as ``|a|b|``."""
    long = {i for _, ids in RULES if len(ids) > 1 for i in ids}
    runs = {s: i for i, s in SENTENCES.items() if i in long} | {s: SAME_AS[i] for i, s in RUNS.items()}
    table = F.create_map(*[F.lit(v) for v in chain(*runs.items())])
    # of two runs that start alike, the longer one
    any_run = " (" + "|".join(sorted(runs, key=len, reverse=True)) + ")(?= )"
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), COMMENT_WORD, " ")
    plain = F.concat(F.lit(" "), F.lower(F.regexp_replace(bare, "[^A-Za-z0-9]+", " ")), F.lit(" "))
    plain = F.regexp_replace(plain, NAMED, NAMED_AS)
    found = F.regexp_extract_all(plain, F.lit(any_run), F.lit(1))
    ids = F.transform(found, lambda s: F.try_element_at(table, s))
    wanted = F.lower(F.coalesce(text, F.lit(""))).rlike("permission|redistribution|apache|free software")
    return F.when(wanted, F.concat(F.lit("|"), F.array_join(ids, "|"), F.lit("|"))).otherwise(F.lit("|"))


def _sequence_text(ids: tuple[str, ...]) -> str:
    return "|" + "|".join(ids) + "|"


def rule_names() -> dict[str, str]:
    """Rule sequence to licence."""
    return {_sequence_text(ids): name for name, ids in RULES}


def _hit(sequence: str, all_rules: list[str]) -> tuple[str, list[str]]:
    return sequence, [r for r in all_rules if sequence in r and r != sequence]


def scan(text: Column) -> Column:
    """Struct: n_sentences, n_known, sequence, licences (sorted, by comma)."""
    rules = list(rule_names())

    def hits(ids: Column) -> list[Column]:
        # each longer rule is taken out before the rules inside it are looked for
        found = []
        for rule in rules:
            sequence, longer = _hit(rule, rules)
            rest = ids
            for other in longer:
                rest = F.replace(rest, F.lit(other), F.lit("|"))
            found.append(F.when(F.contains(rest, F.lit(sequence)), F.lit(rule_names()[rule])))
        return found

    def matched(state: Column) -> Column:
        name, title = TITLE_RULE
        found = [*hits(state["sequence"]), F.when(F.contains(state["sequence"], F.lit(title)), F.lit(name))]
        # nothing by runs without a run: most texts
        by_runs = bind(state["runs"], lambda ids: F.when(ids != "|", F.array(*hits(ids))))
        # a licence text that runs show whole isn't also the shorter one inside it
        names = F.array_compact(F.concat(F.array(*found), F.coalesce(by_runs, F.array().cast("array<string>"))))
        cut_short = F.coalesce(F.array_contains(by_runs, "BSD-3-Clause"), F.lit(False)) & ~F.coalesce(
            F.array_contains(by_runs, "BSD-2-Clause"), F.lit(False)
        )
        names = F.when(cut_short, F.array_remove(names, "BSD-2-Clause")).otherwise(names)
        names = F.array_sort(F.array_distinct(names))
        return F.struct(
            state["n_sentences"].alias("n_sentences"),
            state["n_known"].alias("n_known"),
            state["sequence"].alias("sequence"),
            F.array_join(names, ",").alias("licences"),
        )

    def counted(found: Column, ids: Column) -> Column:
        joined = F.when(F.size(ids) == 0, F.lit("|")).otherwise(
            F.concat(F.lit("|"), F.array_join(ids, "|"), F.lit("|"))
        )
        return F.struct(
            F.size(found).cast("long").alias("n_sentences"),
            F.size(ids).cast("long").alias("n_known"),
            joined.alias("sequence"),
            _run_sequence(text).alias("runs"),
        )

    return bind(
        sentences(text), lambda found: bind(_known(found), lambda ids: bind(counted(found, ids), matched))
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_sentences, n_known, sequence, licences."""
    return docs.select("doc_id", scan(F.col("text")).alias("s")).select("doc_id", "s.*")


def oracle_sql() -> str:
    """The same for DuckDB."""
    keys = ", ".join(f"'{s}'" for s in SENTENCES.values())
    ids = ", ".join(f"'{i}'" for i in SENTENCES)
    rules = list(rule_names())
    tests = []
    for rule in rules:
        sequence, longer = _hit(rule, rules)
        rest = "sequence"
        for other in longer:
            rest = f"replace({rest}, '{other}', '|')"
        tests.append(f"CASE WHEN contains({rest}, '{sequence}') THEN '{rule_names()[rule]}' END")
    end, line = SENTENCE_END.replace("\\\\", "\\"), LINE_END.replace("\\\\", "\\")
    return f"""
WITH known AS (SELECT unnest([{keys}]) AS sentence, unnest([{ids}]) AS id),
cut AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(list_transform(string_split(lower(regexp_replace(
      regexp_replace(regexp_replace(coalesce(text, ''), '{end}', chr(1) || '\\1', 'g'),
        '{line}', chr(1) || '\\1', 'g'), '{NOT_PLAIN}', ' ', 'g')), chr(1)), lambda s: trim(s)),
      lambda s: s <> '') AS found
  FROM documents),
each AS (SELECT r, unnest(found) AS sentence, unnest(range(len(found))) AS i FROM cut),
sequences AS (
  SELECT r, count(*) AS n_known, '|' || string_agg(id, '|' ORDER BY i) || '|' AS sequence
  FROM each JOIN known USING (sentence) GROUP BY r),
whole AS (
  SELECT doc_id, len(found)::BIGINT AS n_sentences, coalesce(n_known, 0)::BIGINT AS n_known,
    coalesce(sequence, '|') AS sequence
  FROM cut LEFT JOIN sequences USING (r))
SELECT doc_id, n_sentences, n_known, sequence,
  array_to_string(list_sort(list_distinct(list_filter([{', '.join(tests)}], lambda x: x IS NOT NULL))), ',') AS licences
FROM whole"""
