"""Licence scans of published texts, variants of the BSD clauses and compound tag lines."""

from pathlib import Path

import pytest

from gridloom.llm import license_rules

COMMON = Path("/usr/share/common-licenses")
NAMES = {
    "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GFDL-1.2": "GFDL-1.2",
    "GFDL-1.3": "GFDL-1.3", "GPL-1": "GPL-1.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2": "LGPL-2.0", "LGPL-2.1": "LGPL-2.1",
    "LGPL-3": "LGPL-3.0", "MPL-1.1": "MPL-1.1", "MPL-2.0": "MPL-2.0",
}
BSD = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

    * Redistributions of source code must retain the above copyright
      notice, this list of conditions and the following disclaimer.
    * Redistributions in binary form must reproduce the above copyright
      notice, this list of conditions and the following disclaimer in the
      documentation and/or other materials provided with the distribution.
"""


def names(spark, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    return [r["licenses"] for r in sorted(license_rules.scan(table).collect(), key=lambda r: r["i"])]


def test_published_texts_have_their_own_names(spark):
    here = [n for n in NAMES if (COMMON / n).is_file()]
    if not here:
        pytest.skip("no published texts on this machine")
    texts = [(COMMON / n).read_text(errors="replace") for n in here]
    assert dict(zip(here, names(spark, texts), strict=True)) == {n: [NAMES[n]] for n in here}
    # as comments of a source file, with other line ends, and without the appendix
    commented = ["\r\n".join(" * " + line for line in t.split("\n")) for t in texts]
    assert dict(zip(here, names(spark, commented), strict=True)) == {n: [NAMES[n]] for n in here}
    cut = [t.split("How to Apply These Terms")[0].split("How to use this License")[0] for t in texts]
    assert dict(zip(here, names(spark, cut), strict=True)) == {n: [NAMES[n]] for n in here}


@pytest.mark.parametrize(
    "third",
    [
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this\n      software without specific prior written permission.",
        "Neither the name of the University nor the names of its contributors\n      may be used to endorse or promote products derived from this software\n      without specific prior written permission.",
        "Neither the name of Example Labs, Inc. nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "The names of the contributors may not be used to endorse or\n      promote products derived from this software without specific\n      prior written permission.",
        "The name of the author may not be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the names of the copyright holders nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
        "Neither the name NumPy nor the names of any contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
)
def test_third_clause_whoever_it_names(spark, third):
    advert = "    * All advertising materials mentioning features or use of this software must display the following acknowledgement:\n      This product includes software developed by A. Person.\n"
    disclaimer = "\nTHIS SOFTWARE IS PROVIDED BY THE AUTHOR ``AS IS'' AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.\n"
    texts = [f"{BSD}    * {third}\n{disclaimer}", f"{BSD}{advert}    * {third}\n{disclaimer}", BSD + disclaimer]
    assert names(spark, texts) == [["BSD-3-Clause"], ["BSD-4-Clause"], ["BSD-2-Clause"]]


def test_a_gap_has_twelve_words_at_most(spark):
    table = {"the name of {} is not to be used": "named", "{} wrote this": "by"}
    rows = [(i, f"The name of {' '.join(['word'] * i)} is not to be used.") for i in (0, 1, 12, 13)] + [(20, "A. N. Other wrote this."), (21, "Nobody wrote that.")]
    got = license_rules.scan(spark.createDataFrame(rows, "i int, text string"), sentences=table, rules=(("Named", ("named",)), ("By", ("by",)))).collect()
    assert {r["i"]: r["licenses"] for r in got} == {0: ["Named"], 1: ["Named"], 12: ["Named"], 13: [], 20: ["By"], 21: []}


def test_compound_tag_lines(spark):
    lines = {
        "MIT OR Apache-2.0": ["Apache-2.0", "MIT"],
        "(MIT OR Apache-2.0) AND BSD-3-Clause": ["Apache-2.0", "BSD-3-Clause", "MIT"],
        "GPL-2.0-only WITH Classpath-exception-2.0": ["GPL-2.0-only"],
        "GPL-2.0-or-later WITH GCC-exception-3.1 OR MIT": ["GPL-2.0-or-later", "MIT"],
        "GPL-2.0+": ["GPL-2.0-or-later"],
        "GPL-2.0": ["GPL-2.0"],
        "LGPL-2.1-or-later": ["LGPL-2.1-or-later"],
        "GPL-3.0-only OR GPL-2.0-only": ["GPL-2.0-only", "GPL-3.0-only"],
        "MIT OR Unheard-Of-7": [],
        "Unheard-Of-7": [],
        "MITX": [],
    }
    texts = [f"{leader}SPDX-License-Identifier: {line}{end}" for line in lines for leader, end in (("// ", "\n\nfn main() {}\n"), ("/* ", " */\n"), ("# ", ""))]
    assert names(spark, texts) == [want for want in lines.values() for _ in range(3)]
