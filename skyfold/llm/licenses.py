"""Licence scans by sentence rules.

A text is cut into sentences and each is normalised; sentences known from
licences become identifiers, all others are dropped. Rules, in order, are then
matched against the sequence of identifiers, and what a rule matches is taken
out before the next one, so a shorter licence is not found inside a longer one.
Marks that begin a comment's lines are no part of a sentence, and the holder that a
BSD text names is read as "the copyright holder".
A known sentence whose published wording is itself cut, by a stop inside, is
known as the run of its pieces. Everything is DataFrame expressions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: fixed values: normalised sentences (lower-case words of a-z and 0-9) by identifier
SENTENCES = {
    "MITtitle": ["mit license", "the mit license", "the mit license mit"],
    "MITref": ["released under the mit license", "licensed under the mit license", "license mit",
               "this project is licensed under the mit license", "this software is released under the mit license",
               "spdx license identifier mit"],
    "MITperm": ["permission is hereby granted free of charge to any person obtaining a copy of this software and "
                "associated documentation files the software to deal in the software without restriction including "
                "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
                "of the software and to permit persons to whom the software is furnished to do so subject to the "
                "following conditions"],
    "MITnotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial "
                  "portions of the software"],
    "AsIs": ["the software is provided as is without warranty of any kind express or implied including but not limited to "
             "the warranties of merchantability fitness for a particular purpose and noninfringement",
             "this software is provided by the copyright holders and contributors as is and any express or implied "
             "warranties including but not limited to the implied warranties of merchantability and fitness for a "
             "particular purpose are disclaimed"],
    "NoLiability": ["in no event shall the authors or copyright holders be liable for any claim damages or other liability "
                    "whether in an action of contract tort or otherwise arising from out of or in connection with the "
                    "software or the use or other dealings in the software",
                    "in no event shall the copyright holder or contributors be liable for any direct indirect incidental "
                    "special exemplary or consequential damages including but not limited to procurement of substitute "
                    "goods or services loss of use data or profits or business interruption however caused and on any "
                    "theory of liability whether in contract strict liability or tort including negligence or otherwise "
                    "arising in any way out of the use of this software even if advised of the possibility of such damage"],
    "ISCperm": ["permission to use copy modify and or distribute this software for any purpose with or without fee is "
                "hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "ISCref": ["licensed under the isc license", "released under the isc license", "spdx license identifier isc"],
    "BSDperm": ["redistribution and use in source and binary forms with or without modification are permitted provided "
                "that the following conditions are met"],
    "BSDsource": ["redistributions of source code must retain the above copyright notice this list of conditions and the "
                  "following disclaimer"],
    "BSDbinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and "
                  "the following disclaimer in the documentation and or other materials provided with the distribution"],
    "BSDendorse": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                   "promote products derived from this software without specific prior written permission"],
    "BSD2ref": ["spdx license identifier bsd 2 clause", "licensed under the bsd 2 clause license"],
    "BSD3ref": ["spdx license identifier bsd 3 clause", "licensed under the bsd 3 clause license"],
    "APACHEref": ["licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license",
                  "released under the apache license version 2 0", "spdx license identifier apache 2 0"],
    "APACHEcomply": ["you may not use this file except in compliance with the license"],
    "APACHEcopy": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "APACHEasis": ["unless required by applicable law or agreed to in writing software distributed under the license is "
                   "distributed on an as is basis without warranties or conditions of any kind either express or implied"],
    "APACHEsee": ["see the license for the specific language governing permissions and limitations under the license"],
    "GPLfree": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                "public license as published by the free software foundation either version 3 of the license or at your "
                "option any later version"],
    "GPL2free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu general "
                 "public license as published by the free software foundation either version 2 of the license or at your "
                 "option any later version"],
    "GPLhope": ["this program is distributed in the hope that it will be useful but without any warranty without even the "
                "implied warranty of merchantability or fitness for a particular purpose"],
    "GPLsee": ["see the gnu general public license for more details"],
    "GPLcopy": ["you should have received a copy of the gnu general public license along with this program"],
    "GPL3ref": ["this work is licensed under the gnu general public license version 3", "spdx license identifier gpl 3 0",
                "licensed under the gnu general public license version 3"],
    "GPL3only": ["spdx license identifier gpl 3 0 only"],
    "GPL3later": ["spdx license identifier gpl 3 0 or later"],
    "GPL2ref": ["this work is licensed under the gnu general public license version 2", "spdx license identifier gpl 2 0",
                "licensed under the gnu general public license version 2"],
    "GPL2only": ["spdx license identifier gpl 2 0 only"],
    "GPL2later": ["spdx license identifier gpl 2 0 or later"],
    "AGPL3free": ["this program is free software you can redistribute it and or modify it under the terms of the gnu affero "
                  "general public license as published by the free software foundation either version 3 of the license or "
                  "at your option any later version"],
    "AGPLsee": ["see the gnu affero general public license for more details"],
    "AGPLcopy": ["you should have received a copy of the gnu affero general public license along with this program"],
    "AGPL3only": ["spdx license identifier agpl 3 0 only"],
    "AGPL3later": ["spdx license identifier agpl 3 0 or later"],
    "LGPL21free": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                   "general public license as published by the free software foundation either version 2 1 of the license "
                   "or at your option any later version"],
    "LGPL3free": ["this library is free software you can redistribute it and or modify it under the terms of the gnu lesser "
                  "general public license as published by the free software foundation either version 3 of the license "
                  "or at your option any later version"],
    "LGPLhope": ["this library is distributed in the hope that it will be useful but without any warranty without even the "
                 "implied warranty of merchantability or fitness for a particular purpose"],
    "LGPLsee": ["see the gnu lesser general public license for more details"],
    "LGPLcopy": ["you should have received a copy of the gnu lesser general public license along with this library"],
    "LGPL21only": ["spdx license identifier lgpl 2 1 only"],
    "LGPL21later": ["spdx license identifier lgpl 2 1 or later"],
    "LGPL3only": ["spdx license identifier lgpl 3 0 only"],
    "LGPL3later": ["spdx license identifier lgpl 3 0 or later"],
    "EPL2ref": ["this program and the accompanying materials are made available under the terms of the eclipse public license "
                "2 0 which is available at https www eclipse org legal epl 2 0",
                "this program and the accompanying materials are made available under the terms of the eclipse public license "
                "v 2 0 which is available at https www eclipse org legal epl 2 0",
                "spdx license identifier epl 2 0"],
    "MPLform": ["this source code form is subject to the terms of the mozilla public license v 2 0"],
    "MPLcopy": ["if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0",
                "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0"],
    "MPLref": ["spdx license identifier mpl 2 0", "licensed under the mozilla public license version 2 0"],
    "CCBYref": ["licensed under cc by 4 0", "this work is licensed under a creative commons attribution 4 0 international license"],
    "CCBYSAref": ["licensed under cc by sa 4 0",
                  "this work is licensed under a creative commons attribution sharealike 4 0 international license"],
    "CCBYNCref": ["licensed under cc by nc 4 0",
                  "this work is licensed under a creative commons attribution noncommercial 4 0 international license"],
    "CC0ref": ["licensed under cc0 1 0", "spdx license identifier cc0 1 0"],
    "Unlicense": ["this is free and unencumbered software released into the public domain"],
    "AllRights": ["all rights reserved"],
}
#: fixed values: (licence, sequence of identifiers), in the order they are tried
RULES = [
    ("MIT", ["MITtitle", "MITperm", "MITnotice", "AsIs", "NoLiability"]),
    ("MIT", ["MITperm", "MITnotice", "AsIs", "NoLiability"]),
    ("BSD-3-Clause", ["BSDperm", "BSDsource", "BSDbinary", "BSDendorse", "AsIs", "NoLiability"]),
    ("BSD-2-Clause", ["BSDperm", "BSDsource", "BSDbinary", "AsIs", "NoLiability"]),
    ("Apache-2.0", ["APACHEref", "APACHEcomply", "APACHEcopy", "APACHEasis", "APACHEsee"]),
    ("GPL-3.0-or-later", ["GPLfree", "GPLhope", "GPLsee", "GPLcopy"]),
    ("GPL-2.0-or-later", ["GPL2free", "GPLhope", "GPLsee", "GPLcopy"]),
    ("AGPL-3.0-or-later", ["AGPL3free", "GPLhope", "AGPLsee", "AGPLcopy"]),
    ("LGPL-2.1-or-later", ["LGPL21free", "LGPLhope", "LGPLsee", "LGPLcopy"]),
    ("LGPL-3.0-or-later", ["LGPL3free", "LGPLhope", "LGPLsee", "LGPLcopy"]),
    ("MPL-2.0", ["MPLform", "MPLcopy"]),
    ("ISC", ["ISCperm"]),
    ("GPL-3.0-or-later", ["GPLfree"]),
    ("GPL-2.0-or-later", ["GPL2free"]),
    ("AGPL-3.0-or-later", ["AGPL3free"]),
    ("LGPL-2.1-or-later", ["LGPL21free"]),
    ("LGPL-3.0-or-later", ["LGPL3free"]),
    ("MPL-2.0", ["MPLform"]),
    ("MIT", ["MITref"]),
    ("Apache-2.0", ["APACHEref"]),
    ("BSD-2-Clause", ["BSD2ref"]),
    ("BSD-3-Clause", ["BSD3ref"]),
    ("GPL-3.0", ["GPL3ref"]),
    ("GPL-2.0", ["GPL2ref"]),
    ("GPL-3.0-only", ["GPL3only"]),
    ("GPL-3.0-or-later", ["GPL3later"]),
    ("GPL-2.0-only", ["GPL2only"]),
    ("GPL-2.0-or-later", ["GPL2later"]),
    ("AGPL-3.0-only", ["AGPL3only"]),
    ("AGPL-3.0-or-later", ["AGPL3later"]),
    ("LGPL-2.1-only", ["LGPL21only"]),
    ("LGPL-2.1-or-later", ["LGPL21later"]),
    ("LGPL-3.0-only", ["LGPL3only"]),
    ("LGPL-3.0-or-later", ["LGPL3later"]),
    ("EPL-2.0", ["EPL2ref"]),
    ("MPL-2.0", ["MPLref"]),
    ("ISC", ["ISCref"]),
    ("CC-BY-4.0", ["CCBYref"]),
    ("CC-BY-SA-4.0", ["CCBYSAref"]),
    ("CC-BY-NC-4.0", ["CCBYNCref"]),
    ("CC0-1.0", ["CC0ref"]),
    ("Unlicense", ["Unlicense"]),
    ("MIT", ["MITtitle"]),
]
#: identifiers that stand between a licence's sentences without being part of it
NEUTRAL = ["AllRights"]

#: published wordings of known sentences that the patterns below cut into several pieces
PUBLISHED = [
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
    "later version.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any "
    "later version.",
    "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any "
    "later version.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
    "License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any "
    "later version.",
    "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
    "any later version.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) "
    "any later version.",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
    "Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) "
    "any later version.",
    "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied "
    "warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "This program and the accompanying materials are made available under the terms of the Eclipse Public License v. 2.0 "
    "which is available at https://www.eclipse.org/legal/epl-2.0",
    "IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, "
    "EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; "
    "LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN "
    "CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS "
    "SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.",
    "You may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0",
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "If a copy of the MPL was not distributed with this file, You can obtain one at\n\n    http://mozilla.org/MPL/2.0/.",
    "If a copy of the MPL was not distributed with this file, You can obtain one at\n\n    https://mozilla.org/MPL/2.0/.",
    "License: MIT",
    *[f"SPDX-License-Identifier: {name}" for name in (
        "MIT", "ISC", "BSD-2-Clause", "BSD-3-Clause", "Apache-2.0", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later",
        "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "MPL-2.0", "CC0-1.0", "AGPL-3.0-only", "AGPL-3.0-or-later",
        "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "EPL-2.0")],
]

#: fixed values: wordings around the name of a BSD text's holder, and what stands for every name
HOLDERS = [
    ("neither the name of ", "the copyright holder", " nor the names of its contributors"),
    ("this software is provided by ", "the copyright holders and contributors", " as is and any express or implied"),
    ("in no event shall ", "the copyright holder or contributors", " be liable for any direct indirect incidental"),
]

#: sentences end at a stop before white space; a line of its own, such as a title,
#: ends at its line break; other line breaks may be wrapped lines
WHITE_SPACE = "[\\x20\\x09-\\x0D]"
STOP = f"[.:;!?]+(?:{WHITE_SPACE}|$)"
BREAKS = {"line": f"(?:{STOP}|\\n)", "wrapped": f"(?:{STOP}|\\n{WHITE_SPACE}*\\n)"}
MARK = "\x01"
#: marks that begin a line of a comment
COMMENT = "(^|\\n)[\\x20\\x09]*(?:#+|//+[!*]?|/?\\*+/?|;+|<!--|--+|%+)[\\x20\\x09]*"
#: the name of a holder, in normalised words
NAME = "[a-z0-9\\x20]{1,100}"


def _normal(text: str) -> str:
    return re.sub("[^A-Za-z0-9]+", " ", text).lower().strip()


def _runs(by: dict[str, str]) -> tuple[dict[str, str], list[tuple[str, str]]]:
    """Codes of the known sentences and of the pieces of cut ones, and the runs of
    codes that stand for a sentence, each with its identifier, the longest first."""
    codes, runs = dict(by), {}
    for wording in PUBLISHED:
        if _normal(wording) in by:
            pieces = [p for p in map(_normal, re.split(BREAKS["wrapped"], wording)) if p]
            run = [codes.setdefault(p, f"#{len(codes)}") for p in pieces]
            runs["," + ",,".join(run) + ","] = by[_normal(wording)]
    return codes, sorted(runs.items(), key=lambda r: (-r[0].count(","), r[0]))


def _identifiers(text: Column, by: dict[str, str], breaks: str) -> Column:
    """The identifiers of a text's known sentences, in order; the pieces of a cut one
    count where they follow each other with nothing between."""
    codes, runs = _runs(by)
    plain = F.lower(F.regexp_replace(F.regexp_replace(text, breaks, MARK), f"[^A-Za-z0-9{MARK}]+", " "))
    for before, name, after in HOLDERS:
        plain = F.regexp_replace(plain, before + NAME + after, before + name + after)
    sentences = F.split(plain, MARK)
    known = F.create_map(*[F.lit(x) for s, i in codes.items() for x in (s, i)])
    some = F.filter(F.transform(sentences, lambda s: F.trim(s)), lambda s: s != "")
    joined = F.array_join(F.transform(some, lambda s: F.coalesce(F.element_at(known, s), F.lit("#"))), ",,")
    joined = F.concat(F.lit(","), joined, F.lit(","))
    for run, identifier in runs:
        joined = F.replace(joined, F.lit(run), F.lit(f",{identifier},"))
    return F.filter(F.split(joined, ","), lambda i: (i != "") & ~i.startswith("#"))


def _matched(identifiers: Column, rules) -> tuple[Column, Column]:
    """Licences in the order of the rules, and the identifiers no rule took."""
    rest = F.concat(F.lit(","), F.array_join(F.filter(identifiers, lambda i: ~i.isin(*NEUTRAL)), ",,"), F.lit(","))
    found = []
    for licence, sequence in rules:
        run = "," + ",,".join(sequence) + ","
        found.append(F.when(rest.contains(run), F.lit(licence)))
        rest = F.replace(rest, F.lit(run), F.lit(""))
    left = F.filter(F.split(rest, ","), lambda x: x != "")
    return F.array_distinct(F.array_compact(F.array(*found))), left


def scan_licenses(docs: DataFrame, sentences: dict[str, list[str]] = SENTENCES, rules=RULES) -> DataFrame:
    """``docs`` with ``sentence_ids, licenses, unmatched`` (arrays of strings).

    Both ways of reading line breaks are scanned: with each as a sentence's end,
    and with single ones as wrapped lines. The one that knows more sentences
    decides, at a tie the first. A wrapped sentence that ends without a stop runs on to
    the next empty line. A sentence of ``PUBLISHED`` is known by its pieces
    as well as whole. Only texts with a word that all known sentences
    of a kind share are cut up; that test is exact, as it holds for every one.

    Defined cases: null and empty texts, and texts without known sentences, give
    empty arrays; rows are read each for itself, repeated or not, and need no
    id; an empty table gives an empty result; columns of ``docs`` that carry one
    of the added names are replaced.
    """
    by = {s: i for i, known in sentences.items() for s in known}
    words = trigger_words(map(_nameless, by))
    own = [c for c in docs.columns if c not in ("sentence_ids", "licenses", "unmatched")]
    empty = F.array().cast("array<string>")
    likely = F.coalesce(F.col("text").rlike("(?i)" + "|".join(words)), F.lit(False))
    bare = F.regexp_replace("text", COMMENT, "$1")
    both = docs.select(*own, *[F.when(likely, _identifiers(bare, by, b)).otherwise(empty).alias(f"_{k}")
                               for k, b in BREAKS.items()])
    read = both.withColumn("sentence_ids", F.when(F.size("_wrapped") > F.size("_line"), F.col("_wrapped"))
                           .otherwise(F.col("_line"))).drop("_line", "_wrapped")
    some = F.size("sentence_ids") > 0
    licences, left = _matched(F.col("sentence_ids"), rules)
    return read.select(*own, "sentence_ids", F.when(some, licences).otherwise(empty).alias("licenses"),
                       F.when(some, left).otherwise(empty).alias("unmatched"))


def _nameless(sentence: str) -> str:
    """A known sentence without the words that stand for a holder's name."""
    for before, name, after in HOLDERS:
        sentence = sentence.replace(before + name + after, before + after)
    return sentence


def trigger_words(sentences) -> list[str]:
    """Few words such that every sentence holds at least one: the commonest of those
    still without one, again and again."""
    words, rest = [], [set(s.split()) for s in sentences]
    while rest:
        counts: dict[str, int] = {}
        for s in rest:
            for w in s:
                if len(w) >= 5:
                    counts[w] = counts.get(w, 0) + 1
        if not counts:  # sentences of short words only
            return [*words, "."]
        best = max(sorted(counts), key=counts.get)
        words.append(best)
        rest = [s for s in rest if best not in s]
    return words


def oracle() -> str:
    """The same scan in DuckDB's dialect, for the rows of ``op1``."""
    codes, runs = _runs({s: i for i, known in SENTENCES.items() for s in known})
    known = "map {" + ", ".join(f"'{s}': '{i}'" for s, i in codes.items()) + "}"

    def ids(breaks: str) -> str:
        plain = f"lower(regexp_replace(regexp_replace(text, '{breaks}', chr(1), 'g'), '[^A-Za-z0-9\\x01]+', ' ', 'g'))"
        for before, name, after in HOLDERS:
            plain = f"regexp_replace({plain}, '{before}{NAME}{after}', '{before}{name}{after}', 'g')"
        some = f"list_filter(list_transform(string_split({plain}, chr(1)), lambda x: trim(x)), lambda x: x <> '')"
        joined = f"',' || array_to_string(list_transform({some}, lambda x: coalesce({known}[x], '#')), ',,') || ','"
        for run, identifier in runs:
            joined = f"replace({joined}, '{run}', ',{identifier},')"
        return f"list_filter(string_split({joined}, ','), lambda x: x <> '' and x not like '#%')"

    steps = ["select doc_id, ids, ',' || array_to_string(list_filter(ids, lambda x: x not in "
             f"({', '.join(repr(n) for n in NEUTRAL)})), ',,') || ',' as rest, [] :: varchar[] as found from read"]
    for n, (licence, sequence) in enumerate(RULES):
        run = "," + ",,".join(sequence) + ","
        steps.append(f"select doc_id, ids, replace(rest, '{run}', '') as rest, case when contains(rest, '{run}') "
                     f"and not list_contains(found, '{licence}') then list_append(found, '{licence}') else found end as found from r{n}")
    ctes = ", ".join(f"r{n} as ({s})" for n, s in enumerate(steps))
    return f"""
with cut as (select doc_id, {ids(BREAKS["line"])} as a, {ids(BREAKS["wrapped"])} as b
             from (select doc_id, regexp_replace(coalesce(text, ''), '{COMMENT}', '\\1', 'g') as text from documents)),
read as (select doc_id, case when len(b) > len(a) then b else a end as ids from cut), {ctes}
select doc_id, len(ids) as n_sentences, array_to_string(ids, ',') as sentence_ids,
       array_to_string(found, ',') as licenses,
       array_to_string(list_filter(string_split(rest, ','), lambda x: x <> ''), ',') as unmatched
from r{len(RULES)}
"""
