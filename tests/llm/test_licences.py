import re

import pytest

from docloom.llm.licences import CODE, KNOWN, LINE_END, NAMES, ORACLE, PARAGRAPH_END, RULES, SENTENCES, licence_rows


def brute(text):
    norm = lambda s: re.sub("^neither the name of .+ (?=nor the names of its contributors )", "neither the name of the copyright holder ", re.sub("[^a-z0-9]+", " ", s.lower()).strip())
    seqs = [[KNOWN[x] for s in re.split(ends, text or "") if (x := norm(s)) in KNOWN] for ends in (LINE_END, PARAGRAPH_END)]
    out, families = [], set()
    for family, licence, wanted in RULES:
        def holds(seq):
            it = iter(seq)
            return all(w in it for w in wanted)

        if any(map(holds, seqs)) and family not in families:
            families.add(family)
            if licence not in out:
                out.append(licence)
    return ",".join(seqs[0]), ",".join(seqs[1]), ";".join(out)


def test_against_brute_force(spark):
    bsd = [SENTENCES[x] for x in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")]
    texts = [None, "", "Released under the MIT License.", "foo\nLicensed under the Apache License, Version 2.0.\nbar. Licensed under CC BY-NC 4.0.", ". ".join(bsd), ".\n".join(bsd[:3]), ". ".join(reversed(bsd)), "Permission is hereby granted, " + SENTENCES["mit-grant"][29:].replace(" software", "\nsoftware") + ":\n\n" + SENTENCES["mit-condition"] + ".", "x " * 40000 + "\nThis work is licensed under the GNU General Public License, version 3.", "SPDX-License-Identifier: MIT", "released under the mit license now"]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(3, texts[3], "k"), (None, texts[2], "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, licences string")
    got = sorted((tuple(r) for r in licence_rows(df).collect()), key=str)
    assert got == sorted(((i, *brute(t)) for i, t, _ in rows), key=str)
    assert {g[3] for g in got} >= {"", "MIT", "Apache-2.0;CC-BY-NC-4.0", "BSD-3-Clause", "BSD-2-Clause", "GPL-3.0"}
    assert licence_rows(df.limit(0)).count() == 0 and len(set(CODE.values())) == len(CODE) and set(CODE) == set(KNOWN.values()) and len(KNOWN) > 1000 and len(SENTENCES) < len(CODE)


WARRANTY = "This program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.\n"
BSD = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n\n"
MIT = 'Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the "Software"), to deal\nin the Software without restriction, including without limitation the rights\nto use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED'
ISC = 'Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\n'
#: Official wordings, with their wraps.
OFFICIAL = [
    ("MIT", MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "// SPDX-License-Identifier: MIT\nint main();"),
    ("ISC", ISC + 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES\nWITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF\nMERCHANTABILITY AND FITNESS. IN NO EVENT'),
    ("ISC", ISC),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");\nyou may not use this file except in compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\nUnless required by applicable law'),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "# spdx-license-identifier: Apache-2.0"),
    ("BSD-3-Clause", BSD + "3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"),
    ("BSD-2-Clause", BSD),
    ("GPL-3.0-or-later", "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n\n" + WARRANTY),
    ("GPL-3.0-or-later", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 3 of the License, or\n(at your option) any later version.\n\n" + WARRANTY),
    ("GPL-3.0-or-later", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("GPL-2.0-or-later", "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later version.\n\n" + WARRANTY),
    ("GPL-2.0-or-later", " * This program is free software: you can redistribute it and/or modify\n * it under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 2 of the License, or\n * (at your option) any later version.\n\n * " + WARRANTY),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright\nand related or neighboring rights to this work."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MPL-2.0", "/* This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy of the MPL was not distributed with this\n * file, You can obtain one at https://mozilla.org/MPL/2.0/. */"),
    ("", "Identifier: MIT. Mit. SPDX-License-Identifier; v. 2.0"),
]


def test_official_wordings(spark):
    rows = [(i, "Copyright (c) 2020 A. B.\n\n" + t) for i, (_, t) in enumerate(OFFICIAL)]
    got = {r.doc_id: (r.by_line, r.by_paragraph, r.licences) for r in licence_rows(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i][2] for i in range(len(rows))] == [x for x, _ in OFFICIAL]
    assert got == {i: brute(t) for i, t in rows}
    assert {x for x, _ in OFFICIAL if x} == {x for _, x, names in RULES if not names[0].startswith("states-")}


def test_common_wordings(spark):
    names = "3. Neither the name of {} nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"
    cases = [("BSD-3-Clause", BSD + names.format(x)) for x in ("Google Inc.", "the University of X", "the <ORGANIZATION>")]
    cases += [("MIT", "This project is licensed under the MIT License."), ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."), ("CC-BY-4.0", "Creative Commons Attribution 4.0 International"), ("", "neither the name of nor")]
    df = spark.createDataFrame([(i, x) for i, (_, x) in enumerate(cases)], "doc_id long, text string")
    assert {r.doc_id: r.licences for r in licence_rows(df).collect()} == {i: x for i, (x, _) in enumerate(cases)}


def test_stated_licences_and_sql(spark, tmp_path):
    """Every name in some wording, by line and within a paragraph; the SQL gives the same rows."""
    duckdb = pytest.importorskip("duckdb")
    cases = [(licence, f"Hello.\nThis project is licensed under the {name.title()}!") for licence, _, names in NAMES for name in names]
    cases += [("CC-BY-NC-ND-3.0", "This work is licensed under a Creative Commons\nAttribution-NonCommercial-NoDerivatives 3.0 Unported License."), ("CC-BY-SA-4.0", "Distributed under CC BY-SA 4.0"), ("LGPL-3.0;EPL-2.0", "SPDX-License-Identifier: LGPL-3.0-or-later\nReleased under EPL 2.0."), ("", "licensed under the mitt license"), ("", None), ("", "")]
    texts = [t for _, t in cases] + [t for _, t in OFFICIAL] + [BSD + "Neither the name of A nor B nor the names of its contributors may"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, __a string")
    got = {r.doc_id: tuple(r)[1:] for r in licence_rows(docs).collect()}
    assert [got[i][2] for i in range(len(cases))] == [x for x, _ in cases]
    assert got == {i: brute(t) for i, t in enumerate(texts)}
    docs.toPandas().to_parquet(tmp_path / "d.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/d.parquet'")
    assert {r[0]: r[1:] for r in con.execute(ORACLE).fetchall()} == got
