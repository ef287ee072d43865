"""Licence scans by sentence rules, in DataFrame operations alone.

Texts are cut into sentences in two ways, at line ends and where a paragraph ends, so that both notices on a line and wrapped
licence texts are read. Sentences are normalised (lower case, runs of other characters than letters and digits as blanks;
whoever holds the copyright of a BSD text is the copyright holder) and looked up in a table of known licence sentences. What
is found gives a sequence of identifiers per text, in order; ordered rules are matched against it: a rule's identifiers must
occur in its order. Of the rules of a family only the first that matches counts, so a longer licence hides the shorter ones
it contains.

The table has the sentences of licence texts, and, by rule, those that state a licence: each of ``SUBJECTS`` with each name
of ``NAMES`` or of a Creative Commons licence, some two thousand; all that state one licence have one identifier. It is a hash set
of the plan, met by every sentence in place: nothing is shuffled or broadcast, whatever a text repeats. Only sentences that
are in the set are looked up further.

Defined results: null and empty texts have no sentences and no licence; repeated rows are each returned; several licences
are listed in rule order, each once; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Known sentences, normalised, by identifier.
SENTENCES = {
    "mit-notice": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-condition": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "apache-notice": "licensed under the apache license version 2 0",
    "apache-header": "licensed under the apache license version 2 0 the license",
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at http www apache org licenses license 2 0",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "gpl3-notice": "this work is licensed under the gnu general public license version 3",
    "gpl-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-redistribute": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl-details": "see the gnu general public license for more details",
    "cc-by": "licensed under cc by 4 0",
    "cc-by-sa": "licensed under cc by sa 4 0",
    "cc-by-nc": "licensed under cc by nc 4 0",
    "cc-by-nc-sa": "licensed under cc by nc sa 4 0",
    "cc0": "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "unlicense": "this is free and unencumbered software released into the public domain",
    "mpl": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-gpl3": "spdx license identifier gpl 3 0 or later",
    # As the cuts below leave the official notices.
    "apache-obtain": "you may obtain a copy of the license at",
    "apache-url": "http www apache org licenses license 2 0",
    "gpl-free": "this program is free software",
    "gpl-modify": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl3-modify": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2-modify": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl3-either": "either version 3 of the license or at your option any later version",
    "gpl2-either": "either version 2 of the license or at your option any later version",
    # After a holder's name that ends in a stop.
    "bsd-contributors": "nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "mit-project": "this project is licensed under the mit license",
    "cc-by-work": "this work is licensed under a creative commons attribution 4 0 international license",
    "cc-by-name": "creative commons attribution 4 0 international",
}
#: Fixed values: (family, licence, sentences in order), the first of a family first.
RULES = (
    ("mit", "MIT", ("mit-grant", "mit-condition")),
    ("mit", "MIT", ("mit-notice",)),
    ("mit", "MIT", ("mit-licensed",)),
    ("mit", "MIT", ("mit-project",)),
    ("mit", "MIT", ("spdx-mit",)),
    ("isc", "ISC", ("isc-grant", "isc-warranty")),
    ("isc", "ISC", ("isc-grant",)),
    ("apache", "Apache-2.0", ("apache-header", "apache-use", "apache-copy")),
    ("apache", "Apache-2.0", ("apache-header", "apache-use", "apache-obtain", "apache-url")),
    ("apache", "Apache-2.0", ("apache-header",)),
    ("apache", "Apache-2.0", ("apache-notice",)),
    ("apache", "Apache-2.0", ("spdx-apache",)),
    ("bsd", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("bsd", "BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-contributors")),
    ("bsd", "BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("gpl", "GPL-3.0-or-later", ("gpl-redistribute", "gpl-hope")),
    ("gpl", "GPL-3.0-or-later", ("gpl-free", "gpl3-modify", "gpl-hope")),
    ("gpl", "GPL-3.0-or-later", ("gpl-free", "gpl-modify", "gpl3-either", "gpl-hope")),
    ("gpl", "GPL-3.0-or-later", ("spdx-gpl3",)),
    ("gpl", "GPL-2.0-or-later", ("gpl2-redistribute", "gpl-hope")),
    ("gpl", "GPL-2.0-or-later", ("gpl-free", "gpl2-modify", "gpl-hope")),
    ("gpl", "GPL-2.0-or-later", ("gpl-free", "gpl-modify", "gpl2-either", "gpl-hope")),
    ("gpl", "GPL-3.0", ("gpl3-notice",)),
    ("cc", "CC-BY-NC-SA-4.0", ("cc-by-nc-sa",)),
    ("cc", "CC-BY-NC-4.0", ("cc-by-nc",)),
    ("cc", "CC-BY-SA-4.0", ("cc-by-sa",)),
    ("cc", "CC-BY-4.0", ("cc-by",)),
    ("cc", "CC-BY-4.0", ("cc-by-work",)),
    ("cc", "CC-BY-4.0", ("cc-by-name",)),
    ("cc0", "CC0-1.0", ("cc0",)),
    ("unlicense", "Unlicense", ("unlicense",)),
    ("mpl", "MPL-2.0", ("mpl",)),
)
#: Who or what is under a licence; licences' identifiers with family and names; parts and versions of Creative Commons licences.
SUBJECTS = ("released", "licensed", "distributed", "available", "this project is licensed", "this software is licensed", "this work is licensed", "this file is licensed")
NAMES = (
    ("MIT", "mit", ("mit license", "expat license")),
    ("ISC", "isc", ("isc license",)),
    ("Apache-1.1", "apache", ("apache license version 1 1", "apache software license version 1 1")),
    ("Apache-2.0", "apache", ("apache license 2 0", "apache license version 2 0", "apache 2 0 license", "apache license v2 0")),
    ("BSD-2-Clause", "bsd", ("bsd 2 clause license", "2 clause bsd license", "simplified bsd license")),
    ("BSD-3-Clause", "bsd", ("bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license")),
    ("GPL-2.0", "gpl", ("gnu general public license version 2", "gnu general public license v2 0", "gnu gpl v2", "gpl v2", "gplv2")),
    ("GPL-3.0", "gpl", ("gnu general public license version 3", "gnu general public license v3 0", "gnu gpl v3", "gpl v3", "gplv3")),
    ("LGPL-2.1", "lgpl", ("gnu lesser general public license version 2 1", "gnu lesser general public license v2 1", "lgpl v2 1", "lgplv2 1")),
    ("LGPL-3.0", "lgpl", ("gnu lesser general public license version 3", "gnu lesser general public license v3 0", "lgpl v3", "lgplv3")),
    ("AGPL-3.0", "agpl", ("gnu affero general public license version 3", "gnu affero general public license v3 0", "agpl v3", "agplv3")),
    ("MPL-1.1", "mpl", ("mozilla public license 1 1", "mozilla public license version 1 1")),
    ("MPL-2.0", "mpl", ("mozilla public license 2 0", "mozilla public license version 2 0", "mpl 2 0")),
    ("EPL-1.0", "epl", ("eclipse public license 1 0", "eclipse public license version 1 0", "epl 1 0")),
    ("EPL-2.0", "epl", ("eclipse public license 2 0", "eclipse public license version 2 0", "epl 2 0")),
    ("BSL-1.0", "boost", ("boost software license", "boost software license version 1 0")),
    ("Zlib", "zlib", ("zlib license",)),
    ("Artistic-2.0", "artistic", ("artistic license 2 0", "artistic license version 2 0")),
    ("EUPL-1.2", "eupl", ("european union public license version 1 2", "eupl 1 2")),
    ("Unlicense", "unlicense", ("unlicense", "unlicense license")),
    ("WTFPL", "wtfpl", ("do what the fuck you want to public license", "wtfpl")),
    ("CC0-1.0", "cc0", ("cc0 1 0", "cc0 1 0 universal", "creative commons zero v1 0 universal license")),
)
COMMONS = {"by": "attribution", "nc": "noncommercial", "sa": "sharealike", "nd": "noderivatives"}
COMMONS_KINDS, COMMONS_VERSIONS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"), ("2.0", "3.0", "4.0")
#: Endings of SPDX identifiers.
SPDX_FORMS = ("", " only", " or later")


def plain(text: str) -> str:
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in text.lower()).split())


def stated() -> tuple[dict[str, str], list[tuple[str, str, tuple[str, ...]]]]:
    """Sentences that state a licence with their identifiers, ``states-`` and the licence; a rule for each identifier."""
    sentences: dict[str, str] = {}
    rules = []
    for licence, family, names in NAMES:
        code = f"states-{licence.lower()}"
        rules.append((family, licence, (code,)))
        found = [f"{s} under {the}{n}" for s in SUBJECTS for n in names for the in ("the ", "")]
        found += [f"spdx license identifier {plain(licence)}{form}" for form in SPDX_FORMS]
        sentences |= dict.fromkeys(found, code)
    for kind in COMMONS_KINDS:
        for version in COMMONS_VERSIONS:
            licence = f"CC-{kind.upper()}-{version}"
            code, short = f"states-{licence.lower()}", plain(f"cc {kind} {version}")
            long = " ".join(["creative commons", *(COMMONS[x] for x in kind.split("-")), plain(version)])
            names = [short, f"{short} license", *(f"{the}{long}{end}" for the in ("a ", "") for end in (" international license", " unported license", " generic license", " license"))]
            rules.append(("cc", licence, (code,)))
            found = [f"{s} under {n}" for s in SUBJECTS for n in names] + [f"{long} international", f"{long} international license", f"spdx license identifier {short}"]
            sentences |= dict.fromkeys(found, code)
    return sentences, rules


def in_families(rules) -> tuple:
    """The rules with those of a family together, families and a family's rules in order of appearance."""
    order = list(dict.fromkeys(f for f, _, _ in rules))
    return tuple(r for f in order for r in rules if r[0] == f)


_STATED, _STATES = stated()
#: Sentence to identifier: the licences' own sentences before those by rule.
KNOWN = {**_STATED, **{s: n for n, s in SENTENCES.items()}}
RULES = in_families((*RULES, *_STATES))
SQL_LINE_END, SQL_PARAGRAPH_END = r"\n|[.;:!?]+[ \t\r]+", r"\n[ \t\r]*\n|[.;:!?]+[ \t\r\n]+"
#: Not cut: the colon of an SPDX line and the stop in 'License, v. 2.0'.
WITHIN = r"(?<!(?i:spdx-license-identifier))(?<!(?i:license, v))"
LINE_END, PARAGRAPH_END = (x.replace("|", f"|{WITHIN}") for x in (SQL_LINE_END, SQL_PARAGRAPH_END))
#: One character for each identifier, so that a sequence is a text and a rule a pattern.
CODE = {name: chr(0x4E00 + i) for i, name in enumerate(dict.fromkeys([*SENTENCES, *KNOWN.values()]))}


def normalised(sentence: Column) -> Column:
    words = F.btrim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))
    return F.when(words.startswith("neither the name of "), F.regexp_replace(words, "^neither the name of .+ (?=nor the names of its contributors )", "neither the name of the copyright holder ")).otherwise(words)


def sequence(text: Column, ends: str) -> Column:
    """The codes of the known sentences in order."""
    codes = F.create_map(*(F.lit(x) for sentence, name in KNOWN.items() for x in (sentence, CODE[name])))
    known = F.filter(F.transform(F.split(text, ends, -1), normalised), lambda s: s.isin(list(KNOWN)))  # a hash set
    return F.array_join(F.transform(known, lambda s: F.element_at(codes, s)), "")


def pattern(names: tuple[str, ...]) -> str:
    return ".*".join(CODE[n] for n in names)


def licence_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, by_line, by_paragraph, licences): sentence identifiers in order joined by commas, and licences joined by ';' (empty if none)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", sequence(text, LINE_END).alias("__a"), sequence(text, PARAGRAPH_END).alias("__b"))
    hit = lambda names: F.col("__a").rlike(pattern(names)) | F.col("__b").rlike(pattern(names))
    families = dict.fromkeys(f for f, _, _ in RULES)
    found = F.array(*(F.coalesce(*(F.when(hit(names), F.lit(licence)) for f, licence, names in RULES if f == family)) for family in families))
    name_of = F.create_map(*(F.lit(v) for n, k in CODE.items() for v in (k, n)))
    named = lambda c: F.array_join(F.transform(F.filter(F.split(c, ""), lambda x: x != ""), lambda x: F.element_at(name_of, x)), ",")
    blank, none = F.lit(""), (F.col("__a") == "") & (F.col("__b") == "")
    licences = F.when(none, blank).otherwise(F.array_join(F.array_distinct(F.array_compact(found)), ";"))
    return rows.select("doc_id", F.when(F.col("__a") == "", blank).otherwise(named(F.col("__a"))).alias("by_line"), F.when(F.col("__b") == "", blank).otherwise(named(F.col("__b"))).alias("by_paragraph"), licences.alias("licences"))


def _oracle() -> str:
    values = ", ".join(f"('{s}', '{n}', '{CODE[n]}')" for s, n in KNOWN.items())
    rules = ", ".join(f"({i}, '{f}', '{x}', '{pattern(names)}')" for i, (f, x, names) in enumerate(RULES))
    words = "trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))"
    holder = "'^neither the name of .+ (nor the names of its contributors )', 'neither the name of the copyright holder \\1'"
    cut = lambda ends: f"SELECT r, k, CASE WHEN starts_with(x, 'neither the name of ') THEN regexp_replace(x, {holder}) ELSE x END AS x FROM (SELECT r, k, {words} AS x FROM (SELECT r, unnest(p) AS x, generate_subscripts(p, 1) AS k FROM (SELECT r, string_split_regex(text, '{ends}') AS p FROM d)))"
    found = lambda table: f"SELECT r, string_agg(n, ',' ORDER BY k) AS names, string_agg(c, '' ORDER BY k) AS codes FROM {table} JOIN known ON s = x GROUP BY r"
    return f"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_replace(coalesce(text, ''), '(?i)(spdx-license-identifier|license, v)[.;:!?]([ \\t\\r\\n])', '\\1\\2', 'g') AS text FROM documents),
        known(s, n, c) AS (VALUES {values}), rules(i, family, licence, p) AS (VALUES {rules}),
        la AS ({cut(SQL_LINE_END)}), lb AS ({cut(SQL_PARAGRAPH_END)}), a AS ({found('la')}), b AS ({found('lb')}),
        h AS (SELECT r, i, family, licence, row_number() OVER (PARTITION BY r, family ORDER BY i) AS first FROM (SELECT coalesce(a.r, b.r) AS r, coalesce(a.codes, '') AS ca, coalesce(b.codes, '') AS cb FROM a FULL JOIN b ON a.r = b.r) s JOIN rules ON regexp_matches(ca, p) OR regexp_matches(cb, p)),
        l AS (SELECT r, string_agg(licence, ';' ORDER BY i) AS licences FROM h WHERE first = 1 GROUP BY r)
        SELECT doc_id, coalesce(a.names, '') AS by_line, coalesce(b.names, '') AS by_paragraph, coalesce(licences, '') AS licences
        FROM d LEFT JOIN a ON d.r = a.r LEFT JOIN b ON d.r = b.r LEFT JOIN l ON d.r = l.r"""


ORACLE = _oracle()
