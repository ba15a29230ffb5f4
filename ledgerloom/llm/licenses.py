"""Operator 5, license scans by ordered signature rules.

Texts are folded to words, so that a rule is a regular expression over words parted by
single spaces. A keyword automaton passes over the text once; a rule's expression is run
over a text only if its keyword occurs in it; many rules are plain phrases. Rules have
priorities; a detection that lies within a kept one of the same or higher priority is
suppressed. The three base phrases are counted apart and are never suppressed.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import bytewise as bw
from ledgerloom.llm import shared
from ledgerloom.llm.license_clauses import CLAUSES

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
_FOLD = np.where(bw.ALNUM, bw.LOWER, 32).astype(np.uint8).tobytes()

#: label | keyword | expression over words; priorities follow in the sections below
_TEXTS = r"""
apache-2.0 | apache license | (?:licensed under )?(?:the )?apache license (?:version )?2(?: 0)?
apache-2.0 | apache 2 0 | apache 2 0(?: license)?
apache-2.0 | licenses license 2 0 | apache org licenses license 2 0
apache-1.1 | apache software license | apache software license (?:version )?1 1
apache-1.0 | apache license | apache license (?:version )?1 0
apache | apache license | apache license
apache | apache software license | apache software license
mit | mit license | (?:released |licensed )?(?:under )?(?:the )?mit license
mit | mit licensed | mit licensed
mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | opensource org licenses mit | opensource org licenses mit
mit-0 | mit no attribution | mit no attribution
x11 | x11 license | x11 license
x11 | x consortium | x consortium license
expat | expat license | expat license
isc | isc license | isc license
isc | permission to use copy modify and or distribute | permission to use copy modify and or distribute this software for any purpose with or without fee
0bsd | zero clause bsd | zero clause bsd(?: license)?
0bsd | bsd zero clause | bsd zero clause(?: license)?
bsd-2-clause | 2 clause bsd | 2 clause bsd(?: license)?
bsd-2-clause | bsd 2 clause | bsd 2 clause(?: license)?
bsd-2-clause | simplified bsd | simplified bsd license
bsd-2-clause | freebsd license | freebsd license
bsd-3-clause | 3 clause bsd | 3 clause bsd(?: license)?
bsd-3-clause | bsd 3 clause | bsd 3 clause(?: license)?
bsd-3-clause | new bsd | new bsd license
bsd-3-clause | modified bsd | modified bsd license
bsd-3-clause | neither the name of | neither the name of (?:\S+ ){1,12}?nor the names of (?:its|their) contributors may be used
bsd-4-clause | bsd 4 clause | bsd 4 clause(?: license)?
bsd-4-clause | 4 clause bsd | 4 clause bsd(?: license)?
bsd-4-clause | original bsd | original bsd license
bsd-4-clause | all advertising materials | all advertising materials mentioning features or use of this software
bsd | bsd license | bsd (?:style )?license
bsd | bsd licensed | bsd licensed
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
gpl-1.0 | general public license | gnu general public license version 1
gpl-2.0 | general public license | gnu general public license (?:as published by the free software foundation )?(?:either )?version 2
gpl-3.0 | general public license | gnu general public license (?:as published by the free software foundation )?(?:either )?version 3
gpl-2.0-or-later | version 2 of the license or | version 2 of the license or (?:at your option )?any later version
gpl-3.0-or-later | version 3 of the license or | version 3 of the license or (?:at your option )?any later version
gpl-2.0 | gplv2 | gplv2
gpl-3.0 | gplv3 | gplv3
gpl-2.0 | gpl 2 | (?:gnu )?gpl 2(?: 0)?
gpl-3.0 | gpl 3 | (?:gnu )?gpl 3(?: 0)?
gpl | gnu general public license | gnu general public license
gpl | gnu gpl | gnu gpl
gpl | www gnu org licenses gpl | www gnu org licenses gpl
lgpl-2.0 | library general public license | (?:gnu )?library general public license(?: version 2)?
lgpl-2.1 | lesser general public license | (?:gnu )?lesser general public license version 2 1
lgpl-3.0 | lesser general public license | (?:gnu )?lesser general public license version 3
lgpl | lesser general public license | (?:gnu )?lesser general public license
lgpl-2.1 | lgplv2 1 | lgplv2 1
lgpl-3.0 | lgplv3 | lgplv3
lgpl-2.1 | lgpl 2 1 | (?:gnu )?lgpl 2 1
lgpl-3.0 | lgpl 3 | (?:gnu )?lgpl 3(?: 0)?
lgpl | gnu lgpl | gnu lgpl
agpl-3.0 | affero general public license | (?:gnu )?affero general public license version 3
agpl | affero general public license | (?:gnu )?affero general public license
agpl-3.0 | agplv3 | agplv3
agpl-3.0 | agpl 3 | (?:gnu )?agpl 3(?: 0)?
agpl | gnu agpl | gnu agpl
gfdl-1.1 | free documentation license | (?:gnu )?free documentation license version 1 1
gfdl-1.2 | free documentation license | (?:gnu )?free documentation license version 1 2
gfdl-1.3 | free documentation license | (?:gnu )?free documentation license version 1 3
gfdl | free documentation license | (?:gnu )?free documentation license
mpl-1.0 | mozilla public license | mozilla public license (?:v |version )?1 0
mpl-1.1 | mozilla public license | mozilla public license (?:v |version )?1 1
mpl-2.0 | mozilla public license | mozilla public license (?:v |version )?2 0
mpl | mozilla public license | mozilla public license
mpl-2.0 | mozilla org mpl 2 0 | mozilla org mpl 2 0
mpl-1.1 | mozilla org mpl mpl 1 1 | mozilla org mpl mpl 1 1
epl-1.0 | eclipse public license | eclipse public license (?:v |v|version )?1 0
epl-2.0 | eclipse public license | eclipse public license (?:v |v|version )?2 0
epl | eclipse public license | eclipse public license
epl-1.0 | eclipse org legal epl v10 | eclipse org legal epl v10
epl-2.0 | eclipse org legal epl 2 0 | eclipse org legal epl 2 0
edl-1.0 | eclipse distribution license | eclipse distribution license(?: v?1 0)?
cpl-1.0 | common public license | common public license(?: version)?(?: v?1 0)?
ipl-1.0 | ibm public license | ibm public license(?: version)?(?: 1 0)?
cddl-1.0 | common development and distribution license | common development and distribution license(?: version| v)? 1 0
cddl-1.1 | common development and distribution license | common development and distribution license(?: version| v)? 1 1
cddl | common development and distribution license | common development and distribution license
artistic-1.0 | artistic license | artistic license 1 0
artistic-2.0 | artistic license | artistic license (?:version )?2 0
artistic | artistic license | artistic license
perl | same terms as perl itself | (?:under )?the same terms as perl itself
python-2.0 | python software foundation license | python software foundation license(?: version 2)?
psf-2.0 | psf license | psf license
zpl-2.1 | zope public license | zope public license(?: version)? 2 1
zpl | zope public license | zope public license
php-3.01 | php license | php license(?: version)? 3 01
php | php license | php license
ruby | ruby license | ruby(?: s)? license
boost-1.0 | boost software license | boost software license(?: version 1 0)?
zlib | zlib license | zlib(?: libpng)? license
zlib | this software is provided as is without any express or implied warranty | this software is provided as is without any express or implied warranty in no event will the authors be held liable
libpng | libpng license | libpng license
unlicense | unlicense | (?:the )?unlicense
unlicense | free and unencumbered software | this is free and unencumbered software released into the public domain
wtfpl | do what the fuck you want | do what the fuck you want to public license
wtfpl | wtfpl | wtfpl
beerware | beer ware license | the beer ware license
ms-pl | microsoft public license | microsoft public license
ms-rl | microsoft reciprocal license | microsoft reciprocal license
eupl-1.1 | european union public licen | european union public licen[cs]e (?:v |v|version )?1 1
eupl-1.2 | european union public licen | european union public licen[cs]e (?:v |v|version )?1 2
eupl | european union public licen | european union public licen[cs]e
osl-3.0 | open software license | open software license(?: version)? 3 0
osl | open software license | open software license
afl-3.0 | academic free license | academic free license(?: version)? 3 0
afl | academic free license | academic free license
ofl-1.1 | open font license | (?:sil )?open font license(?: version)?(?: 1 1)?
odbl-1.0 | open database license | (?:odc )?open database license(?: v?1 0)?
odc-by-1.0 | open data commons attribution | open data commons attribution license
pddl-1.0 | public domain dedication and license | public domain dedication and license
ogl-3.0 | open government licen | open government licen[cs]e v?3 0
ogl | open government licen | open government licen[cs]e
ncsa | ncsa open source license | (?:university of illinois )?ncsa open source license
postgresql | postgresql license | postgresql licen[cs]e
openssl | openssl license | openssl license
openldap | openldap public license | openldap public license
sleepycat | sleepycat | sleepycat (?:public )?license
w3c | w3c software notice | w3c software notice and license
unicode | unicode license agreement | unicode license agreement
curl | curl license | curl license
vim | vim license | vim license
json | shall be used for good not evil | the software shall be used for good not evil
icu | icu license | icu license
intel | intel open source license | intel open source license
nokia | nokia open source license | nokia open source license
rpl-1.5 | reciprocal public license | reciprocal public license(?: 1 5)?
qpl-1.0 | q public license | q public license(?: version 1 0)?
latex-1.3c | latex project public license | latex project public license(?: version)?(?: v?1 3c)?
cecill-2.1 | cecill | cecill(?: free software license agreement)?(?: version)?(?: 2 1)?
upl-1.0 | universal permissive license | universal permissive license(?: version)?(?: v?1 0)?
bsl-1.1 | business source license | business source license(?: version)?(?: 1 1)?
sspl-1.0 | server side public license | server side public license(?: version)?(?: 1)?
elastic-2.0 | elastic license | elastic license(?: version)?(?: v?2(?: 0)?)?
commons-clause | commons clause | commons clause(?: license)?
polyform | polyform | polyform (?:noncommercial|small business|strict|shield|perimeter|free trial) license
blueoak-1.0.0 | blue oak model license | blue oak model license(?: 1 0 0)?
mulan-2.0 | mulan | mulan (?:psl|permissive software license)(?: v2)?
public-domain | public domain | (?:is |are |released |placed |dedicated )?(?:in |into |to )?the public domain
cc0-1.0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0-1.0 | creative commons zero | creative commons zero(?: 1 0)?
cc0-1.0 | creativecommons org publicdomain zero | creativecommons org publicdomain zero(?: 1 0)?
pdm-1.0 | public domain mark | public domain mark(?: 1 0)?
fair-use | fair use | (?:under|constitutes|for) fair use
proprietary | proprietary and confidential | proprietary and confidential
proprietary | this software is proprietary | this software is proprietary
proprietary | unauthorized copying | unauthorized copying (?:of this file )?(?:via any medium )?is strictly prohibited
proprietary | end user license agreement | end user license agreement
proprietary | no part of this | no part of this (?:publication|work|book|document) may be reproduced
commercial | commercial license | (?:under |with )?(?:a )?commercial license
non-commercial | non commercial use only | (?:for )?non commercial use only
non-commercial | noncommercial use only | (?:for )?noncommercial use only
educational | educational use only | (?:for )?educational use only
copyright | copyright c | copyright c (?:19|20)\d\d(?: (?:19|20)\d\d)*
copyright | copyright 19 | copyright 19\d\d
copyright | copyright 20 | copyright 20\d\d
"""
#: The Creative Commons licenses: short elements and the words of their long names.
_CC = {
    "by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s?", "by-nc": "attribution non ?commercial",
    "by-nc-sa": "attribution non ?commercial share ?alike", "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
_CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
#: Ids that stand after "SPDX-License-Identifier:" and in package metadata.
_SPDX = """0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause BSL-1.0 CC0-1.0
CDDL-1.0 CDDL-1.1 CECILL-2.1 ECL-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 GFDL-1.3 GPL-2.0 GPL-2.0-only GPL-2.0-or-later GPL-3.0 GPL-3.0-only GPL-3.0-or-later
ISC LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 LGPL-3.0-only LGPL-3.0-or-later LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL NCSA ODbL-1.0 OFL-1.1
OSL-3.0 PostgreSQL Python-2.0 QPL-1.0 Ruby UPL-1.0 Unlicense Vim W3C WTFPL X11 Zlib ZPL-2.1"""


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    pattern: re.Pattern


def rules() -> list[Rule]:
    """All rules in order: identifiers first, then versioned names, then names and notices."""
    made = []

    def add(label: str, priority: int, keyword: str, expression: str) -> None:
        made.append(Rule(label, priority, keyword, re.compile(f"(?<= )(?:{expression})(?= )")))

    spaced = lambda x: re.sub("[^a-z0-9]", " ", x.lower())
    for name in _SPDX.split():
        add(name.lower(), 90, "spdx license identifier", f"spdx license identifier {spaced(name)}")
    for short, long in _CC.items():
        for v in _CC_VERSIONS:
            add(f"cc-{short}-{v}", 80, f"cc {spaced(short)}", f"(?:licensed under )?cc {spaced(short)} {spaced(v)}")
            add(f"cc-{short}-{v}", 80, "creative commons attribution", f"creative commons {long} {spaced(v)}")
            add(f"cc-{short}-{v}", 80, "creativecommons org licenses", f"creativecommons org licenses {spaced(short)} {spaced(v)}")
        add(f"cc-{short}", 40, f"cc {spaced(short)}", f"cc {spaced(short)}")
        add(f"cc-{short}", 40, "creative commons attribution", f"creative commons {long}")
    for line in [*_TEXTS.strip().split("\n"), *CLAUSES.strip().split("\n")]:
        label, keyword, expression = (x.strip() for x in line.split("|", 2))
        add(label, 70 if re.search(r"\d", label) else 50 if len(expression.split()) > 6 else 40, keyword, expression)
    return made


def suppress(found: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Of (start, end, priority, label), those not contained in one kept before: by priority, then length, then place.

    What lies in a suppressed detection lies in a kept one too, so that it is enough to ask
    how far all before reach from starts up to one's own: a tree of greatest ends by start.
    """
    order = sorted({*found}, key=lambda x: (-x[2], x[0] - x[1], x[0], x[3]))
    rank = {s: i for i, s in enumerate(sorted({x[0] for x in order}), 1)}
    reach = [-1] * (len(rank) + 1)
    kept = []
    for one in order:
        start, end = one[:2]
        i, far = rank[start], -1
        while i:
            far = max(far, reach[i])
            i &= i - 1
        if far >= end:
            continue
        kept.append(one)
        i = rank[start]
        while i < len(reach):
            reach[i] = max(reach[i], end)
            i += i & -i
    return sorted(kept)


class Scanner:
    def __init__(self):
        import ahocorasick

        self.by: dict[str, list[Rule]] = {}
        for r in rules():
            self.by.setdefault(r.keyword, []).append(r)
        self.gate = ahocorasick.Automaton()
        for k in {*self.by, *BASE}:
            self.gate.add_word(k, k)
        self.gate.make_automaton()

    def __call__(self, text: str) -> dict:
        """Counts, labels, score and kept detections of one text (spans in words)."""
        words = text.encode().translate(_FOLD).split()
        out = {"n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": "", "labels": "", "score": 0.0, "detections": []}
        said = f" {b' '.join(words).decode()} "
        keys = {k for _, k in self.gate.iter(said)}
        if not keys:
            return out
        base, starts, found = set(), [], []
        for phrase in keys & {*BASE}:
            at = said.find(f" {phrase} ")
            while at >= 0:
                base.add(BASE[phrase])
                starts.append(at)
                at = said.find(f" {phrase} ", at + 1)
        for k in keys & {*self.by}:
            for rule in self.by[k]:
                found += [(m.start(), m.end(), rule.priority, rule.label) for m in rule.pattern.finditer(said)]
        kept = suppress(found)
        # places in characters become words: blanks are counted once
        places = np.unique([*starts, *(x for k in kept for x in k[:2])]).astype(np.int64)
        word, n, at = {}, 0, 0
        for p in places.tolist():
            n += said.count(" ", at, p)
            at = p
            word[p] = n
        starts = [word[at] for at in starts]
        own = {x[3] for x in kept}
        if starts:
            out |= {"n_base": len(starts), "first_word": min(starts), "last_word": max(starts), "base_labels": ",".join(sorted(base))}
        doubt = 1.0
        for priority in {label: p for _, _, p, label in kept}.values():
            doubt *= 1 - priority / 100
        for _ in base - own:
            doubt *= 0.5
        out |= {"labels": ",".join(sorted(base | own)), "score": round(1 - doubt, 6), "detections": [(x[3], word[x[0]] - 1, word[x[1]], x[2]) for x in kept]}
        return out


_made: list[Scanner] = []
_FIELDS = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,start:int,end:int,priority:int>>"


def _scan(texts: pa.Array) -> list[list]:
    if not _made:
        _made.append(Scanner())
    names = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    rows = [_made[0](t.as_py() or "") for t in texts]
    spans = [[dict(zip(("label", "start", "end", "priority"), d, strict=True)) for d in r["detections"]] for r in rows]
    kind = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("priority", pa.int32())]))
    return [*([r[n] for r in rows] for n in names), pa.array(spans, kind)]


def scan_licenses(docs: DataFrame, keep: tuple[str, ...] | None = None) -> DataFrame:
    """``row`` (struct of the columns ``keep``, all where None) and each text's findings.

    n_words, n_base, first_word and last_word (null without base phrases), base_labels,
    labels, score, and detections: label, first word, word after the last, priority. Null
    and empty texts have no words, no labels and score 0. Very long texts are read whole, in
    time that grows with their words and detections. Repeated rows are scanned alike;
    an empty table gives no rows.
    """
    return bw.annotate(docs, _scan, _FIELDS, keep)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(shared.read(spark, sf_dir, "documents"), keep=("doc_id",))
    return found.select("row.doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
