"""License scan: ordered signature rules behind a keyword prefilter, overlaps resolved by priority and containment.

A text is folded to words (A-Z lower-cased, everything but letters, digits and
non-ASCII removed) joined by single blanks; rules are regexes over that form. A
rule runs only on texts in which an Aho-Corasick pass saw its keyword. Of
overlapping detections, one whose interval lies inside that of a better one
(higher priority; then longer; then earlier rule) is suppressed. Rules marked
``always`` are never suppressed.

Nulls and empty texts: no words, no detections, score 0. Ids may be null or
repeat: the operator works row by row. Extra columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textloom.llm.common import arrow_stage, fold_words, load, texts


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    priority: int
    always: bool = False


#: The phrases every scan reports.
BASE = [
    Rule("cc-by", "cc by", "cc by", 50, True),
    Rule("gpl", "general public license", "general public license", 50, True),
    Rule("reserved", "all rights reserved", "all rights reserved", 50, True),
]

#: Notices and grants: label | keyword | priority | regex over folded words.
NOTICES = r"""
apache-2.0 | apache | 90 | licensed under the apache license version 2 0
apache-2.0 | apache | 85 | apache license version 2(?: 0)?
apache-2.0 | apache | 80 | apache (?:software )?license 2(?: 0)?
apache-2.0 | apache | 95 | www apache org licenses license 2 0(?: txt| html)?
apache-1.1 | apache | 85 | apache (?:software )?license version 1 1
apache-1.0 | apache | 85 | apache (?:software )?license version 1 0
apache | apache | 60 | apache(?: software)? license
apache | apache software foundation | 60 | licensed to the apache software foundation
mit | permission is hereby granted free of charge | 95 | permission is hereby granted free of charge to any person obtaining a copy of this software(?: and associated documentation files)?
mit | mit | 85 | (?:licensed|released|available|distributed) under (?:the )?(?:terms of the )?mit license
mit | mit | 80 | (?:the )?mit license(?: mit)?
mit | mit | 90 | opensource org licenses mit(?: license php)?
mit-0 | mit | 90 | mit no attribution(?: license)?
x11 | x11 | 80 | x11 license
isc | isc | 85 | isc license
isc | permission to use copy modify | 90 | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
0bsd | bsd | 90 | (?:bsd zero clause|zero clause bsd) license
bsd-2-clause | bsd | 90 | (?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: simplified)? license
bsd-3-clause | bsd | 90 | (?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)(?: new| revised)? license
bsd-4-clause | bsd | 90 | (?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?
bsd | bsd | 70 | bsd (?:style )?license
bsd | redistribution and use in source and binary forms | 85 | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | neither the name of | 88 | neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse
bsd-4-clause | advertising materials | 88 | all advertising materials mentioning features or use of this software must display
gpl-2.0-only | general public license | 95 | gnu general public license (?:as published by the free software foundation )?version 2 only
gpl-2.0 | general public license | 85 | gnu general public license (?:as published by the free software foundation )?(?:version|v) ?2(?: 0)?
gpl-3.0 | general public license | 85 | gnu general public license (?:as published by the free software foundation )?(?:version|v) ?3(?: 0)?
gpl-2.0-or-later | general public license | 95 | gnu general public license as published by the free software foundation either version 2 of the license or(?: at your option)? any later version
gpl-3.0-or-later | general public license | 95 | gnu general public license as published by the free software foundation either version 3 of the license or(?: at your option)? any later version
gpl | general public license | 60 | gnu general public license
gpl | gpl | 55 | (?:under|the) (?:terms of the )?gnu gpl
gpl-2.0 | gpl | 80 | gpl ?v ?2(?: 0)?
gpl-3.0 | gpl | 80 | gpl ?v ?3(?: 0)?
gpl | www gnu org licenses | 75 | www gnu org licenses(?: gpl)?(?: html)?
gpl | you should have received a copy | 65 | you should have received a copy of the gnu general public license along with
lgpl-2.0 | library general public license | 90 | gnu library general public license(?: version 2(?: 0)?)?
lgpl-2.1 | lesser general public license | 92 | gnu lesser general public license (?:version|v) ?2 1
lgpl-3.0 | lesser general public license | 92 | gnu lesser general public license (?:version|v) ?3(?: 0)?
lgpl | lesser general public license | 80 | gnu lesser general public license
lgpl-2.1 | lgpl | 80 | lgpl ?v ?2 1
lgpl-3.0 | lgpl | 80 | lgpl ?v ?3(?: 0)?
lgpl | lgpl | 60 | under the (?:gnu )?lgpl
agpl-3.0 | affero general public license | 92 | gnu affero general public license (?:version|v) ?3(?: 0)?
agpl | affero general public license | 80 | (?:gnu )?affero general public license
agpl-3.0 | agpl | 80 | agpl ?v ?3(?: 0)?
gfdl | free documentation license | 85 | gnu free documentation license(?: version 1 [123])?
classpath-exception | classpath exception | 85 | with (?:the )?classpath exception
gcc-exception | runtime library exception | 85 | gcc runtime library exception(?: version 3 1)?
mpl-1.0 | mozilla public license | 88 | mozilla public license (?:version |v ?)?1 0
mpl-1.1 | mozilla public license | 88 | mozilla public license (?:version |v ?)?1 1
mpl-2.0 | mozilla public license | 88 | mozilla public license (?:version |v ?)?2 0
mpl | mozilla public license | 70 | mozilla public license
mpl-2.0 | mozilla org mpl | 92 | mozilla org mpl 2 0
epl-1.0 | eclipse public license | 88 | eclipse public license (?:version |v ?)?1 0
epl-2.0 | eclipse public license | 88 | eclipse public license (?:version |v ?)?2 0
epl | eclipse public license | 70 | eclipse public license
edl-1.0 | eclipse distribution license | 85 | eclipse distribution license(?: (?:version |v ?)?1 0)?
cddl-1.0 | development and distribution license | 88 | common development and distribution license (?:cddl )?(?:version |v ?)?1 0
cddl | development and distribution license | 75 | common development and distribution license
cpl-1.0 | common public license | 85 | common public license(?: (?:version |v ?)?1 0)?
ipl-1.0 | ibm public license | 85 | ibm public license(?: (?:version |v ?)?1 0)?
eupl-1.1 | european union public licen | 88 | european union public licen[cs]e (?:eupl )?(?:version |v ?)?1 1
eupl-1.2 | european union public licen | 88 | european union public licen[cs]e (?:eupl )?(?:version |v ?)?1 2
eupl | european union public licen | 75 | european union public licen[cs]e
artistic-1.0 | artistic license | 85 | artistic license 1 0
artistic-2.0 | artistic license | 85 | artistic license 2 0
artistic | artistic license | 70 | artistic license
perl | same terms as perl | 75 | (?:under )?the same terms as perl(?: itself)?
ruby | ruby | 75 | ruby(?: s)? license
python-2.0 | python software foundation license | 85 | python software foundation license(?: version 2)?
php-3.01 | php license | 85 | php license version 3 01
php | php license | 70 | php license
zlib | zlib | 80 | zlib(?: libpng)? license
zlib | altered source versions | 85 | altered source versions must be plainly marked as such
libpng | png | 80 | (?:png reference library|libpng) license(?: version 2)?
bsl-1.0 | boost software license | 88 | boost software license(?: version 1 0)?
bsl-1.0 | boost org | 92 | www boost org license 1 0 txt
unlicense | unlicense | 80 | (?:the unlicense|unlicense org)
unlicense | released into the public domain | 85 | free and unencumbered software released into the public domain
wtfpl | do what the | 85 | do what the [^ ]+ you want to public license
cc0-1.0 | cc0 | 85 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | public domain dedication | 85 | public domain dedication
public-domain | public domain | 60 | (?:in|into) the public domain
public-domain | no copyright | 60 | no copyright is claimed
cc-by-4.0 | attribution 4 0 | 85 | creative commons attribution 4 0 international(?: public)?(?: license)?
cc-by-4.0 | cc by 4 0 | 85 | cc by 4 0
cc-by-3.0 | cc by 3 0 | 85 | cc by 3 0
cc-by-2.0 | cc by 2 0 | 85 | cc by 2 0
cc-by-sa-4.0 | sharealike 4 0 | 92 | creative commons attribution sharealike 4 0(?: international)?(?: license)?
cc-by-sa-4.0 | cc by sa 4 0 | 92 | cc by sa 4 0
cc-by-sa-3.0 | cc by sa 3 0 | 92 | cc by sa 3 0
cc-by-sa | cc by sa | 80 | cc by sa
cc-by-sa | attribution share | 80 | creative commons attribution share ?alike
cc-by-nc-4.0 | cc by nc 4 0 | 92 | cc by nc 4 0
cc-by-nc | cc by nc | 80 | cc by nc
cc-by-nc | attribution non | 80 | creative commons attribution non ?commercial
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | 96 | cc by nc sa 4 0
cc-by-nc-sa | cc by nc sa | 88 | cc by nc sa
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | 96 | cc by nc nd 4 0
cc-by-nc-nd | cc by nc nd | 88 | cc by nc nd
cc-by-nd-4.0 | cc by nd 4 0 | 92 | cc by nd 4 0
cc-by-nd | cc by nd | 80 | cc by nd
cc | creative commons | 60 | (?:licensed under )?(?:a )?creative commons(?: [^ ]+)? licen[cs]e
cc-by | creativecommons org licenses by | 90 | creativecommons org licenses by [1234] [05](?: deed)?
cc-by-sa | creativecommons org licenses by sa | 92 | creativecommons org licenses by sa [1234] [05]
cc-by-nc | creativecommons org licenses by nc | 92 | creativecommons org licenses by nc [1234] [05]
cc0-1.0 | creativecommons org publicdomain | 92 | creativecommons org publicdomain zero 1 0
odbl-1.0 | open database license | 85 | (?:odc )?open database license(?: (?:odbl )?(?:v ?)?1 0)?
odc-by-1.0 | open data commons attribution | 85 | open data commons attribution license
pddl-1.0 | public domain dedication and license | 90 | (?:odc )?public domain dedication and license
ogl-uk-3.0 | open government licen | 85 | open government licen[cs]e (?:v|version )?3(?: 0)?
ogl | open government licen | 75 | open government licen[cs]e
ofl-1.1 | open font license | 85 | (?:sil )?open font license(?: (?:version )?1 1)?
afl-3.0 | academic free license | 85 | academic free license(?: (?:version |v ?)?3 0)?
osl-3.0 | open software license | 85 | open software license(?: (?:version |v ?)?3 0)?
ms-pl | microsoft public license | 85 | microsoft public license(?: ms pl)?
ms-rl | microsoft reciprocal license | 85 | microsoft reciprocal license(?: ms rl)?
ncsa | ncsa | 85 | university of illinois ncsa open source license
ecl-2.0 | educational community license | 85 | educational community license(?: (?:version )?2 0)?
postgresql | postgresql | 80 | postgresql licen[cs]e
openssl | openssl | 80 | openssl license
curl | curl | 75 | curl license
w3c | w3c | 80 | w3c (?:software )?(?:notice and )?license
json | good not evil | 85 | the software shall be used for good not evil
beerware | beer ware | 80 | beer ware license
vim | vim license | 75 | vim license
tcl | tcl | 70 | tcl tk license
upl-1.0 | universal permissive license | 85 | universal permissive license(?: (?:version |v ?)?1 0)?
qpl-1.0 | q public license | 80 | q public license
sleepycat | sleepycat | 75 | sleepycat license
sspl-1.0 | server side public license | 85 | server side public license(?: (?:version )?1)?
busl-1.1 | business source license | 85 | business source license(?: 1 1)?
elastic-2.0 | elastic license | 85 | elastic license(?: 2 0)?
commons-clause | commons clause | 85 | commons clause license condition
polyform-noncommercial | polyform | 85 | polyform noncommercial license
openrail-m | rail m | 85 | (?:creativeml |bigscience )?(?:bigcode )?open ?rail m(?: license)?
llama-community | llama | 80 | llama [0-9]+(?: [0-9]+)? community license
gemma | gemma terms | 80 | gemma terms of use
cecill-2.1 | cecill | 80 | cecill (?:free software )?license agreement
mulan-psl-2.0 | mulan | 85 | mulan permissive software license
nasa-1.3 | nasa open source | 85 | nasa open source agreement(?: version 1 3)?
ijg | independent jpeg group | 80 | independent jpeg group s software
unicode | unicode | 80 | unicode (?:inc )?license agreement
freetype | freetype | 80 | freetype (?:project )?license
imagemagick | imagemagick | 75 | imagemagick license
copyright | copyright | 40 | copyright (?:c )?(?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?
copyright | all rights reserved | 40 | copyright (?:[^ ]+ ){1,8}all rights reserved
proprietary | proprietary | 60 | (?:proprietary and confidential|confidential and proprietary)
proprietary | unauthorized | 65 | unauthorized (?:copying|reproduction|use|distribution) (?:[^ ]+ ){0,8}strictly prohibited
proprietary | may not be reproduced | 65 | may not be reproduced (?:[^ ]+ ){0,6}without (?:the )?(?:prior )?(?:written )?permission
as-is | as is | 35 | provided as is without (?:any )?(?:express or implied )?warrant(?:y|ies)
as-is | without warranty | 35 | without warranty of any kind express or implied
no-liability | in no event shall | 35 | in no event shall the (?:authors?|copyright holders?)(?: or (?:authors?|copyright holders?))? be liable
unknown-license | licensed under | 30 | (?:is )?licensed under the (?:terms of the )?[^ ]+(?: [^ ]+){0,3} licen[cs]e
unknown-license | permission | 30 | (?:used|reproduced|reprinted) (?:here )?with(?: kind)? permission
german-copyright | alle rechte vorbehalten | 60 | alle rechte vorbehalten
french-copyright | tous droits | 60 | tous droits réservés
spanish-copyright | todos los derechos reservados | 60 | todos los derechos reservados
german-license | lizenz | 50 | (?:lizenziert unter|veröffentlicht unter) (?:der|einer) [^ ]+(?: [^ ]+){0,3} lizenz
french-license | licence | 50 | sous (?:la )?licence [^ ]+
spanish-license | licencia | 50 | bajo (?:la |una )?licencia [^ ]+
"""

#: License identifiers that may follow a machine-readable tag.
TAGGED = """0BSD AFL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause
BSD-4-Clause BSL-1.0 BUSL-1.1 CC-BY-3.0 CC-BY-4.0 CC-BY-NC-4.0 CC-BY-NC-ND-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0
CC-BY-SA-3.0 CC-BY-SA-4.0 CC0-1.0 CDDL-1.0 CECILL-2.1 CPL-1.0 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3-only
GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later HPND ISC LGPL-2.1-only LGPL-2.1-or-later
LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0
OFL-1.1 OSL-3.0 OpenSSL PDDL-1.0 PHP-3.01 PostgreSQL Python-2.0 Ruby SSPL-1.0 UPL-1.0 Unlicense Vim W3C WTFPL
X11 Zlib""".split()


def rules() -> list[Rule]:
    """All rules, in order: base phrases, notices, and tag rules made from the identifiers."""
    made = list(BASE)
    for line in NOTICES.strip().splitlines():
        label, keyword, priority, pattern = (x.strip() for x in line.split(" | ", 3))
        made.append(Rule(label, keyword, pattern, int(priority)))
    for name in TAGGED:
        words = " ".join(w.decode() for w in fold_words(name.encode()))
        made.append(Rule(name.lower(), "spdx license identifier", f"spdx license identifier {words}", 99))
        made.append(Rule(name.lower(), "license", f"license(?: expression| id| identifier)? {words}", 70))
    return made


class Scanner:
    """Compiled rules; built once for each Python worker."""

    def __init__(self, rule_list: list[Rule]):
        self.rules = rule_list
        self.regexes = [re.compile(f"(?<= )(?:{r.pattern})(?= )") for r in rule_list]
        self.gate = ahocorasick.Automaton()
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(rule_list):
            by_keyword.setdefault(r.keyword, []).append(i)
        for k, found in by_keyword.items():
            self.gate.add_word(k, found)
        self.gate.make_automaton()

    def detect(self, text: bytes) -> tuple[int, list[tuple[int, int, int, bool]]]:
        """Number of words, and detections (first word, word after the last, rule, suppressed)."""
        words = fold_words(text)
        if not words:
            return 0, []
        line = " " + b" ".join(words).decode("utf-8", "replace") + " "
        wanted = sorted({i for _, found in self.gate.iter(line) for i in found})
        spans = [(m.start(), m.end(), i) for i in wanted for m in self.regexes[i].finditer(line)]
        if not spans:
            return len(words), []
        word_at, at, n = {}, 0, -1
        for pos in sorted({p for s, e, _ in spans for p in (s, e + 1)}):
            n += line.count(" ", at, pos)
            at = pos
            word_at[pos] = n
        spans = [(word_at[s], word_at[e + 1], i) for s, e, i in spans]
        return len(words), suppress(spans, [(r.priority, r.always) for r in self.rules])


def suppress(spans: list[tuple[int, int, int]], rank: list[tuple[int, bool]]) -> list[tuple[int, int, int, bool]]:
    """Marks detections that lie inside a better one: best first, each found by bisection among the outermost intervals so far (n log n comparisons; a list insertion each)."""
    starts: list[int] = []
    ends: list[int] = []  # both ascend: an interval inside another is not kept here
    out = []
    for s, e, i in sorted(spans, key=lambda x: (-rank[x[2]][0], x[0] - x[1], x[2], x[0])):
        k = bisect_right(starts, s)
        inside = k > 0 and ends[k - 1] >= e
        if not inside:
            lo = k - (k > 0 and starts[k - 1] == s)
            hi = bisect_right(ends, e)
            starts[lo : max(lo, hi)] = [s]
            ends[lo : max(lo, hi)] = [e]
        out.append((s, e, i, inside and not rank[i][1]))
    return sorted(out)


DETECTION = T.StructType(
    [
        T.StructField("label", T.StringType()),
        T.StructField("rule", T.IntegerType()),
        T.StructField("priority", T.IntegerType()),
        T.StructField("first_word", T.LongType()),
        T.StructField("end_word", T.LongType()),
        T.StructField("base", T.BooleanType()),
        T.StructField("suppressed", T.BooleanType()),
    ]
)
OUTPUT = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("detections", T.ArrayType(DETECTION))])


def scan_licenses(df: DataFrame, text: str = "text", rule_list: list[Rule] | None = None, keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_words`` and ``detections`` (all of them, suppressed ones marked). One narrow pass, no shuffle."""
    rule_list = rules() if rule_list is None else rule_list
    arrow = pa.list_(pa.struct([("label", pa.string()), ("rule", pa.int32()), ("priority", pa.int32()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("base", pa.bool_()), ("suppressed", pa.bool_())]))
    state: dict[str, Scanner] = {}

    def fn(cols):
        if "s" not in state:
            state["s"] = Scanner(rule_list)
        found = [state["s"].detect(t) for t in texts(cols["text"])]
        rows = [[dict(label=(r := rule_list[i]).label, rule=i, priority=r.priority, first_word=s, end_word=e, base=r.always, suppressed=x) for s, e, i, x in d] for _, d in found]
        return [pa.array([n for n, _ in found], pa.int64()), pa.array(rows, arrow)]

    return arrow_stage(df, {"text": text}, OUTPUT, fn, keep)


def op1_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base phrases, surviving labels and score (1 - product of 1 - priority/100 over surviving labels)."""
    found = scan_licenses(load(spark, sf_dir, "documents"), keep=["doc_id"])
    base = F.filter("detections", lambda d: d["base"])
    kept = F.filter("detections", lambda d: ~d["suppressed"])
    joined = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda d: d["label"]))), ",")
    starts = F.transform(base, lambda d: d["first_word"])
    sure = F.array_distinct(F.transform(kept, lambda d: F.struct(d["label"], d["priority"])))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(kept).alias("labels"),
        (F.lit(1.0) - F.aggregate(sure, F.lit(1.0), lambda a, d: a * (F.lit(1.0) - d["priority"] / F.lit(100.0)))).alias("score"),
        F.size(F.filter("detections", lambda d: d["suppressed"])).cast("long").alias("n_suppressed"),
    )
