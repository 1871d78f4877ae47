"""Licence scans by sentence rules.

A text's words are normalised and the places marked where sentences may end; known licence sentences
between two such places, whatever places are inside them, become identifiers, so line wraps, comment
leaders and ';' or ':' within a sentence do not hide it; the sequence of identifiers is matched against ordered rules.  Everything
is an expression over the row, so a scan shuffles nothing.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of published licences and of notices that name one, and their identifiers; {} stands
# for at most twelve words that differ from text to text.
SENTENCES: dict[str, str] = {
    "Released under the MIT License": "mit-name",
    "Licensed under the MIT License": "mit-name",
    "This project is licensed under the MIT License": "mit-name",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions": "mit-grant",
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software": "mit-notice",
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT": "mit-warranty",
    "Licensed under the Apache License, Version 2.0": "apache-2-name",
    "Licensed under the Apache License, Version 2.0 (the \"License\")": "apache-2-name",
    "you may not use this file except in compliance with the License": "apache-2-comply",
    "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0": "apache-2-copy",
    "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied": "apache-2-warranty",
    "This work is licensed under the GNU General Public License, version 3": "gpl-3-name",
    "Licensed under the GNU General Public License, version 3": "gpl-3-name",
    "Licensed under the GNU General Public License, version 2": "gpl-2-name",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "gpl-3-grant",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version": "gpl-2-grant",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY": "gpl-warranty",
    "Licensed under CC BY 4.0": "cc-by-4-name",
    "Licensed under CC BY-SA 4.0": "cc-by-sa-4-name",
    "Licensed under CC BY-NC 4.0": "cc-by-nc-4-name",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-4-name",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met": "bsd-grant",
    "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer": "bsd-source",
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution": "bsd-binary",
    "All advertising materials mentioning features or use of this software must display the following acknowledgement": "bsd-advert",
    "Neither the name of {} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "Neither the name of {} nor the names of their contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "Neither the names of {} nor the names of {} may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "Neither the name of {} nor the names of {} may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "Neither the name {} may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "The name of {} may not be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "The names of {} may not be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "The names of {} may not be used to endorse or promote products derived from this software without prior written permission": "bsd-names",
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd-names",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted": "0bsd-grant",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation": "gpl-2-only-grant",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "lgpl-3-grant",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version": "agpl-3-grant",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version": "lgpl-2.1-grant",
    "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY": "lgpl-warranty",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0": "mpl-2-name",
    "This is free and unencumbered software released into the public domain": "unlicense-name",
    "Distributed under the Boost Software License, Version 1.0": "bsl-1-name",
    "This software is provided 'as-is', without any express or implied warranty": "zlib-warranty",
    "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions": "zlib-grant",
    "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed": "wtfpl-grant",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License": "cc-by-sa-4-name",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "cc-by-nc-4-name",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License": "cc-by-nd-4-name",
    "GNU GENERAL PUBLIC LICENSE Version 1, February 1989": "gpl-1-title",
    "The license agreements of most software companies try to keep users at the mercy of those companies": "gpl-1-preamble",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 1, or (at your option) any later version": "gpl-1-grant",
    "GNU GENERAL PUBLIC LICENSE Version 2, June 1991": "gpl-2-title",
    "The licenses for most software are designed to take away your freedom to share and change it": "gnu-freedom",
    "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007": "gpl-3-title",
    "The GNU General Public License is a free, copyleft license for software and other kinds of works": "gpl-3-preamble",
    "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007": "agpl-3-title",
    "The GNU Affero General Public License is a free, copyleft license for software and other kinds of works, specifically designed to ensure cooperation with the community in the case of network server software": "agpl-3-preamble",
    "GNU LIBRARY GENERAL PUBLIC LICENSE Version 2, June 1991": "lgpl-2-title",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Library General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version": "lgpl-2-grant",
    "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999": "lgpl-2.1-title",
    "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007": "lgpl-3-title",
    "This version of the GNU Lesser General Public License incorporates the terms and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions listed below": "lgpl-3-terms",
    "GNU Free Documentation License Version 1.2, November 2002": "gfdl-1.2-title",
    "GNU Free Documentation License Version 1.3, 3 November 2008": "gfdl-1.3-title",
    "The purpose of this License is to make a manual, textbook, or other functional and useful document \"free\" in the sense of freedom": "gfdl-purpose",
    "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.2 or any later version published by the Free Software Foundation": "gfdl-1.2-grant",
    "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free Documentation License, Version 1.3 or any later version published by the Free Software Foundation": "gfdl-1.3-grant",
    "Apache License Version 2.0, January 2004": "apache-2-title",
    "\"License\" shall mean the terms and conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document": "apache-2-terms",
    "MOZILLA PUBLIC LICENSE Version 1.1": "mpl-1.1-title",
    "\"Commercial Use\" means distribution or otherwise making the Covered Code available to a third party": "mpl-1.1-use",
    "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\")": "mpl-1.1-name",
    "Mozilla Public License Version 2.0": "mpl-2-title",
    "means each individual or legal entity that creates, contributes to the creation of, or owns Covered Software": "mpl-2-contributor",
    "The intent of this document is to state the conditions under which a Package may be copied, such that the Copyright Holder maintains some semblance of artistic control over the development of the package, while giving the users of the package the right to use and distribute the Package in a more-or-less customary fashion, plus the right to make reasonable modifications": "artistic-1-intent",
    "You may embed this Package's interpreter within an executable of yours (by linking)": "artistic-1-perl",
    "CC0 1.0 Universal": "cc0-title",
    "The laws of most jurisdictions throughout the world automatically confer exclusive Copyright and Related Rights (defined below) upon the creator and subsequent owner(s) (each and all, an \"owner\") of an original work of authorship and/or a database (each, a \"Work\")": "cc0-purpose",
    "PYTHON SOFTWARE FOUNDATION LICENSE VERSION 2": "psf-2-title",
    "This LICENSE AGREEMENT is between the Python Software Foundation (\"PSF\"), and the Individual or Organization (\"Licensee\") accessing and otherwise using {} in source or binary form and its associated documentation": "psf-2-parties",
    "Eclipse Public License - v 2.0": "epl-2-title",
    "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (\"AGREEMENT\")": "epl-terms",
}

# Licences and the identifier sequences that stand for them, in their order in a text.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("MIT", ("mit-name",)),
    ("MIT", ("mit-grant", "mit-notice", "mit-warranty")),
    ("Apache-2.0", ("apache-2-name",)),
    ("GPL-3.0", ("gpl-3-name",)),
    ("GPL-3.0-or-later", ("gpl-3-grant", "gpl-warranty")),
    ("GPL-2.0", ("gpl-2-name",)),
    ("GPL-2.0-or-later", ("gpl-2-grant", "gpl-warranty")),
    ("CC-BY-4.0", ("cc-by-4-name",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4-name",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4-name",)),
    ("BSD-3-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-grant", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant",)),
    ("0BSD", ("0bsd-grant",)),
    ("GPL-2.0-only", ("gpl-2-only-grant",)),
    ("LGPL-3.0-or-later", ("lgpl-3-grant", "gpl-warranty")),
    ("AGPL-3.0-or-later", ("agpl-3-grant", "gpl-warranty")),
    ("LGPL-2.1-or-later", ("lgpl-2.1-grant", "lgpl-warranty")),
    ("MPL-2.0", ("mpl-2-name",)),
    ("Unlicense", ("unlicense-name",)),
    ("BSL-1.0", ("bsl-1-name",)),
    ("Zlib", ("zlib-warranty", "zlib-grant")),
    ("WTFPL", ("wtfpl-grant",)),
    ("CC-BY-ND-4.0", ("cc-by-nd-4-name",)),
    ("BSD-4-Clause", ("bsd-grant", "bsd-source", "bsd-binary", "bsd-advert", "bsd-names")),
    # whole texts, whose appendix shows a notice that says nothing of the text it stands in
    ("GPL-1.0", ("gpl-1-title", "gpl-1-preamble")),
    ("GPL-1.0", ("gpl-1-title", "gpl-1-preamble", "gpl-1-grant", "gpl-warranty")),
    ("GPL-1.0-or-later", ("gpl-1-grant", "gpl-warranty")),
    ("GPL-2.0", ("gpl-2-title", "gnu-freedom")),
    ("GPL-2.0", ("gpl-2-title", "gnu-freedom", "gpl-2-grant", "gpl-warranty")),
    ("GPL-3.0", ("gpl-3-title", "gpl-3-preamble")),
    ("GPL-3.0", ("gpl-3-title", "gpl-3-preamble", "gpl-3-grant", "gpl-warranty")),
    ("AGPL-3.0", ("agpl-3-title", "agpl-3-preamble")),
    ("AGPL-3.0", ("agpl-3-title", "agpl-3-preamble", "agpl-3-grant", "gpl-warranty")),
    ("LGPL-2.0", ("lgpl-2-title", "gnu-freedom")),
    ("LGPL-2.0", ("lgpl-2-title", "gnu-freedom", "lgpl-2-grant", "lgpl-warranty")),
    ("LGPL-2.0-or-later", ("lgpl-2-grant", "lgpl-warranty")),
    ("LGPL-2.1", ("lgpl-2.1-title", "gnu-freedom")),
    ("LGPL-2.1", ("lgpl-2.1-title", "gnu-freedom", "lgpl-2.1-grant", "lgpl-warranty")),
    ("LGPL-3.0", ("lgpl-3-title", "lgpl-3-terms")),
    ("GFDL-1.2", ("gfdl-1.2-title", "gfdl-purpose")),
    ("GFDL-1.2", ("gfdl-1.2-title", "gfdl-purpose", "gfdl-1.2-grant")),
    ("GFDL-1.2-or-later", ("gfdl-1.2-grant",)),
    ("GFDL-1.3", ("gfdl-1.3-title", "gfdl-purpose")),
    ("GFDL-1.3", ("gfdl-1.3-title", "gfdl-purpose", "gfdl-1.3-grant")),
    ("GFDL-1.3-or-later", ("gfdl-1.3-grant",)),
    ("Apache-2.0", ("apache-2-title", "apache-2-terms")),
    ("MPL-1.1", ("mpl-1.1-title", "mpl-1.1-use")),
    ("MPL-1.1", ("mpl-1.1-name",)),
    ("MPL-2.0", ("mpl-2-title", "mpl-2-contributor")),
    ("Artistic-1.0-Perl", ("artistic-1-intent", "artistic-1-perl")),
    ("CC0-1.0", ("cc0-title", "cc0-purpose")),
    ("PSF-2.0", ("psf-2-title", "psf-2-parties")),
    ("EPL-2.0", ("epl-2-title", "epl-terms")),
)

#: Each licence's tag line is a sentence, and a rule, of its own.
TAGGED = tuple(
    dict.fromkeys(
        [name for name, _ in RULES]
        + ["EPL-1.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "GPL-1.0-only", "GPL-3.0-only", "LGPL-2.0-only", "LGPL-2.1-only", "LGPL-3.0-only"]
        + ["AGPL-3.0-only", "GFDL-1.2-only", "GFDL-1.3-only", "MPL-1.0", "Artistic-2.0", "Apache-1.1", "CDDL-1.0", "EUPL-1.2", "BSD-1-Clause"]
    )
)
_TAG = "SPDX-License-Identifier: "
SENTENCES |= {f"{_TAG}{name}": f"spdx-{name.lower()}" for name in TAGGED}
RULES += tuple((name, (f"spdx-{name.lower()}",)) for name in TAGGED)

#: Sentences may end at a mark before white space, and at a line end that is followed by a blank line, a capital, a digit or a bullet.
_SENTENCE_END = r"(?<=[.!?;:])\s+|\n\s*\n|\n(?=\s*[\p{Lu}0-9*-])"
#: What comment lines begin with ('*' and '-' are bullets too, and normalised away).
_LEADER = r"(?m)^[ \t]*(?:/\*+|//+|#+|;+|<!--+|(?:dnl|REM)(?=\s))[ \t]*"
_END = "\x01"
_SPACE = r"[ \x01]"
#: A gap of a sentence, behind words of it and ahead of its first.
_GAP, _GAP_AHEAD = r"(?:[ \x01][^ \x01]+){0,12}?", r"(?:[^ \x01]+[ \x01]){0,12}?"


def normalised(text: Column) -> Column:
    """Letters and digits, lower-cased, with single spaces, or ``_END`` where a sentence may end, also in
    front and behind; 'licence' spelt with s, dots kept inside numbers, '+' behind a number as 'or later'."""
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, _END, " "), r"\r\n?", "\n"), _LEADER, "")
    s = F.regexp_replace(F.lower(F.regexp_replace(s, _SENTENCE_END, _END)), "licenc", "licens")
    s = F.regexp_replace(F.regexp_replace(s, r"(?<=[0-9])\+", " or later "), r"(?<![0-9])\.|\.(?![0-9])", " ")
    s = F.regexp_replace(s, r"[^\p{L}\p{N}.\x01]+", " ")
    return F.regexp_replace(F.concat(F.lit(_END), s, F.lit(_END)), r" *\x01[ \x01]*", _END)


def scan(docs: DataFrame, text: str = "text", sentences: Mapping[str, str] = SENTENCES, rules: Sequence[tuple[str, tuple[str, ...]]] = RULES) -> DataFrame:
    """Add ``sentence_ids`` (identifiers in order), and ``licenses`` (names whose rules match, sorted).

    A sentence may have gaps (``{}``) of up to twelve words.  A tag line may join names by AND and OR, each of
    which has its identifier; an exception behind WITH adds none.  A line with a name that no sentence has is
    not looked at.

    A rule matches where its identifiers follow each other with no other known sentence between.
    Identifiers are read from left to right, the longest rule that fits takes them, and reading goes on
    behind them, so a text that has the longer form first and the shorter one later has both names, and a
    whole licence has its own name, not that of the notice in its appendix.  A null or empty text has none;
    repeated rows, empty tables and other columns pass through; columns of the two names are replaced.
    """
    unique: dict[tuple[str, ...], str] = {}
    for s, i in sentences.items():
        unique.setdefault(tuple(map(_plain, s.split("{}"))), i)
    unique = {parts: i for parts, i in unique.items() if any(parts)}
    tag = _plain(_TAG)
    tagged = {parts[0].removeprefix(tag).strip(): i for parts, i in unique.items() if len(parts) == 1 and parts[0].startswith(tag + " ")}
    known = {parts[0]: i for parts, i in unique.items() if len(parts) == 1} | tagged
    gapped = [(_form(parts), i) for parts, i in unique.items() if len(parts) > 1]
    forms = [_form(parts) for parts in sorted(unique, key=lambda parts: -sum(map(len, parts)))]
    if tagged:
        name = "(?:" + "|".join(_form((n,)) for n in sorted(tagged, key=len, reverse=True)) + f")(?={_SPACE}|$)"
        beyond = rf"(?:{_SPACE}with(?:{_SPACE}(?!and{_SPACE}|or{_SPACE})[^ \x01]+){{1,6}})?"
        forms.insert(0, rf"{_form((tag,))}{_SPACE}{name}{beyond}(?:{_SPACE}(?:and|or){_SPACE}{name}{beyond})*")
    ids_of = F.create_map(*[F.lit(v) for pair in known.items() for v in pair]) if known else F.create_map().cast("map<string,string>")

    def identifiers(hit: Column) -> Column:
        said = F.translate(hit, _END, " ")
        one = F.coalesce(F.try_element_at(ids_of, said), *[F.when(said.rlike(f"^(?:{form})$"), F.lit(i)) for form, i in gapped])
        if not tagged:
            return F.array(one)
        names = F.regexp_extract_all(F.substr(said, F.lit(len(tag) + 2)), F.lit(rf"(?:(?<=^)|(?<=\band )|(?<=\bor )){name}"), 0)
        return F.when(F.startswith(said, F.lit(tag + " ")), F.transform(names, lambda n: F.try_element_at(ids_of, n))).otherwise(F.array(one))

    hits = F.regexp_extract_all(normalised(F.coalesce(F.col(f"`{text}`"), F.lit(""))), F.lit(rf"(?<=\x01)(?:{'|'.join(forms) or '(?!)'})(?=\x01)"), 0)
    ids = F.flatten(F.transform(hits, identifiers))
    named: dict[str, list[str]] = {}
    for name, sequence in rules:
        if sequence:
            named.setdefault(",".join(sequence), []).append(name)
    order = sorted(named, key=lambda sequence: -sequence.count(","))
    fits = rf"(?<=,)(?:{'|'.join(map(re.escape, order)) or '(?!)'})(?=,)"
    chain = F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(","))
    names = F.create_map(*[c for sequence, of in named.items() for c in (F.lit(sequence), F.array(*map(F.lit, of)))])
    found = F.flatten(F.transform(F.regexp_extract_all(chain, F.lit(fits), 0), lambda s: F.try_element_at(names, s)))
    return docs.withColumn("sentence_ids", ids).withColumn("licenses", F.sort_array(F.array_distinct(found)))


def _form(parts: tuple[str, ...]) -> str:
    """The pattern of a sentence, given between its gaps."""
    first, *further = (p.replace(".", r"\.").replace(" ", _SPACE) for p in parts)
    for part in further:
        first += _GAP + _SPACE + part if first and part else _GAP if first else _GAP_AHEAD + part
    return first


def _plain(sentence: str) -> str:
    """:func:`normalised`, without ends, for the table's sentences."""
    s = sentence.lower().replace("licenc", "licens")
    s = regex.sub(r"(?<![0-9])\.|\.(?![0-9])", " ", s)
    return regex.sub(r"[^\p{L}\p{N}.]+", " ", s).strip()
