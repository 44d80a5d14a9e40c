"""Signature rules for licence statements, written by hand and expanded over versions.

A rule is a label, a priority (smaller is stronger) and a pattern in which a blank stands for
anything between two words. Its gate keywords, which every match contains, follow from the pattern.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# Names under which licences are known. label; name forms; versions.
FAMILIES = """
gpl; gnu general public licen[sc]e|gnu gpl|general public licen[sc]e; 1 2 3
lgpl; gnu lesser general public licen[sc]e|gnu library general public licen[sc]e|gnu lgpl|lesser general public licen[sc]e; 2 2.1 3
agpl; gnu affero general public licen[sc]e|gnu agpl|affero general public licen[sc]e; 1 3
gfdl; gnu free documentation licen[sc]e|gnu fdl; 1.1 1.2 1.3
apache; apache software licen[sc]e|apache licen[sc]e|licensed under apache; 1 1.1 2
mpl; mozilla public licen[sc]e|mozilla mpl; 1 1.1 2
epl; eclipse public licen[sc]e; 1 2
eupl; european union public licen[sc]e; 1 1.1 1.2
cpl; common public licen[sc]e; 1
cddl; common development and distribution licen[sc]e; 1 1.1
osl; open software licen[sc]e; 1 1.1 2 2.1 3
afl; academic free licen[sc]e; 1.1 1.2 2 2.1 3
artistic; artistic licen[sc]e|perl artistic licen[sc]e; 1 2
apsl; apple public source licen[sc]e; 1 1.1 1.2 2
bsl; business source licen[sc]e; 1 1.1
boost; boost software licen[sc]e; 1
lppl; latex project public licen[sc]e; 1 1.1 1.2 1.3
ofl; sil open font licen[sc]e|open font licen[sc]e; 1 1.1
odbl; open data commons open database licen[sc]e|open database licen[sc]e; 1
odc-by; open data commons attribution licen[sc]e; 1
pddl; open data commons public domain dedication and licen[sc]e; 1
zpl; zope public licen[sc]e; 1.1 2 2.1
php; php licen[sc]e; 3 3.01
python; python software foundation licen[sc]e|psf licen[sc]e; 2
sspl; server side public licen[sc]e; 1
elastic; elastic licen[sc]e; 1 2
ms-pl; microsoft public licen[sc]e;
ms-rl; microsoft reciprocal licen[sc]e;
cecill; cecill free software licen[sc]e|cecill licen[sc]e; 1 1.1 2 2.1
openrail; open responsible ai licen[sc]e|openrail licen[sc]e; 1
mulan-psl; mulan permissive software licen[sc]e; 1 2
qpl; q public licen[sc]e; 1
ecl; educational community licen[sc]e; 1 2
upl; universal permissive licen[sc]e; 1
"""
# Creative commons parts; each is expanded to names, codes and versions.
CC_PARTS = """
by; attribution
by-sa; attribution share ?alike
by-nd; attribution no ?deriv(?:ative)?s?
by-nc; attribution non ?commercial
by-nc-sa; attribution non ?commercial share ?alike
by-nc-nd; attribution non ?commercial no ?deriv(?:ative)?s?
"""
CC_VERSIONS = "1 2 2.5 3 4"
# Single rules. label; priority; pattern.
SINGLE = """
mit; 0; permission is hereby granted free of charge to any person obtaining a copy of this software
mit; 1; (?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?mit licen[sc]e
mit; 2; (?:the )?mit licen[sc]e
mit; 2; expat licen[sc]e
mit; 3; licen[sc]e mit
mit; 3; mit licensed
mit-0; 1; mit no attribution
x11; 1; x11 licen[sc]e
isc; 0; isc licen[sc]e permission to use
isc; 1; (?:the )?isc licen[sc]e
isc; 0; permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
bsd; 0; redistribution and use in source and binary forms with or without modification are permitted
bsd-2-clause; 1; (?:2|two) clause bsd licen[sc]e
bsd-2-clause; 1; simplified bsd licen[sc]e
bsd-2-clause; 1; freebsd licen[sc]e
bsd-2-clause; 1; bsd (?:2|two) clause(?: licen[sc]e)?
bsd-3-clause; 1; (?:3|three) clause bsd licen[sc]e
bsd-3-clause; 1; bsd (?:3|three) clause(?: licen[sc]e)?
bsd-3-clause; 1; (?:new|revised|modified) bsd licen[sc]e
bsd-4-clause; 1; bsd (?:4|four) clause(?: licen[sc]e)?
bsd-4-clause; 1; original bsd licen[sc]e
0bsd; 1; (?:0|zero) clause bsd
0bsd; 1; bsd zero clause
bsd; 3; bsd(?: style)? licen[sc]e
zlib; 0; the origin of this software must not be misrepresented
zlib; 1; zlib(?: libpng)? licen[sc]e
unlicense; 0; this is free and unencumbered software released into the public domain
unlicense; 1; the unlicense
wtfpl; 1; do what the f\\w* you want to public licen[sc]e
wtfpl; 2; wtfpl
beerware; 1; beer ?ware licen[sc]e
ncsa; 1; (?:university of illinois )?ncsa(?: open source)? licen[sc]e
ntp; 1; ntp licen[sc]e
openssl; 1; openssl licen[sc]e
postgresql; 1; postgresql licen[sc]e
ruby; 1; ruby licen[sc]e
vim; 1; vim licen[sc]e
w3c; 1; w3c (?:software )?(?:notice and )?licen[sc]e
json; 0; the software shall be used for good not evil
json; 1; json licen[sc]e
curl; 1; curl licen[sc]e
icu; 1; icu licen[sc]e
unicode; 1; unicode licen[sc]e(?: agreement)?
sleepycat; 1; sleepycat licen[sc]e
watcom; 1; sybase open watcom public licen[sc]e
ibm-pl; 1; ibm public licen[sc]e
intel; 1; intel open source licen[sc]e
nasa; 1; nasa open source agreement
nokia; 1; nokia open source licen[sc]e
gpl; 0; this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e
lgpl; 0; this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e
agpl; 0; redistribute it and or modify it under the terms of the gnu affero general public licen[sc]e
apache-2; 0; licensed under the apache licen[sc]e version 2 0 the licen[sc]e you may not use this file except in compliance
apache-2; 1; apache org licenses licen[sc]e 2 0
mpl-2; 0; this source code form is subject to the terms of the mozilla public licen[sc]e v 2 0
epl; 0; this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e
cc0; 1; (?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc0; 1; creative commons zero
cc; 4; creative commons licen[sc]e
public-domain; 1; dedicated to the public domain
public-domain; 2; (?:released|placed|put|in) (?:in|into|to)?(?: ?the )?public domain
public-domain; 3; public domain mark
all-rights-reserved; 3; all rights reserved
all-rights-reserved; 3; alle rechte vorbehalten
all-rights-reserved; 3; tous droits réservés
all-rights-reserved; 3; todos los derechos reservados
proprietary; 2; proprietary and confidential
proprietary; 3; proprietary licen[sc]e
commercial; 3; commercial licen[sc]e
no-redistribution; 2; redistribution is (?:strictly )?prohibited
no-redistribution; 2; may not be reproduced without (?:prior )?(?:written )?permission
educational-use; 3; for educational use only
non-commercial; 3; for non ?commercial use only
research-only; 3; for research purposes only
fair-use; 4; fair use
copyright; 4; copyright (?:c )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?
copyright; 4; © ?(?:19|20)\\d\\d
"""
SPDX = "spdx licen[sc]e identifier {}"

WORD = rb"0-9a-z\x80-\xff"
# Chance that a detection of this priority is a licence statement; set by hand.
CONFIDENCE = (1.0, 0.95, 0.9, 0.75, 0.5)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    gates: tuple[bytes, ...]
    pattern: re.Pattern[bytes]
    source: str


def pattern(source: str) -> re.Pattern[bytes]:
    """A pattern over lower-cased UTF-8 in which a blank stands for what lies between words."""
    between = rb"[^" + WORD + rb"]+"
    body = source.encode()
    body = body.replace(b" ?", b"(?:" + between + b")?").replace(b" ", between)
    return re.compile(rb"(?<![" + WORD + rb"])(?:" + body + rb")(?![" + WORD + rb"])")


def _lines(table: str) -> list[list[str]]:
    return [[x.strip() for x in line.split(";")] for line in table.strip().splitlines()]


def gate_words(source: str) -> tuple[bytes, ...]:
    """Words that every match holds: those outside groups and without anything optional."""
    sure = source
    while "(?:" in sure:
        sure = re.sub(r"\(\?:[^()]*\)\??", " ", sure)
    sure = re.sub(r"\\\w\*?|[a-z]\?|\[sc\]e", " ", sure)
    words = re.findall("[a-z0-9©À-ɏ]+", sure)
    return tuple(w.encode() for w in ([w for w in words if len(w) >= 3] or words))


def _spoken(version: str) -> str:
    """1 as ``1`` or ``1.0``; 2.1 as ``2.1``: words of digits."""
    whole, _, part = version.partition(".")
    return f"{whole} {part}" if part else f"{whole}(?: 0)?"


def _code(name: str, version: str) -> str:
    return f"{name} {_spoken(version)}(?: (?:only|or later))?"


def rules() -> list[Rule]:
    """All rules, strongest first."""
    table: list[tuple[str, int, str]] = []
    for label, priority, source in _lines(SINGLE):
        table.append((label, int(priority), source.replace("\\\\", "\\")))
    for label, forms, versions in _lines(FAMILIES):
        spoken = label.replace("-", " ")
        for form in forms.split("|"):
            for v in versions.split():
                table.append((f"{label}-{v}", 1, f"{form} (?:v ?|version )?{_spoken(v)}"))
            table.append((label, 2, f"(?:under|by|terms of) the {form}"))
            table.append((label, 3, form))
        for v in versions.split():
            table.append((f"{label}-{v}", 1, SPDX.format(_code(spoken, v))))
            if label in ("gpl", "lgpl", "agpl", "gfdl", "mpl", "epl", "cddl"):
                table.append((f"{label}-{v}", 2, f"{label} ?v? ?{_spoken(v)}(?: only| or later)?"))
    for code, name in _lines(CC_PARTS):
        spoken = code.replace("-", " ")
        for start in (f"creative commons {name}", f"cc {spoken}", f"creativecommons org licenses {spoken}"):
            for v in CC_VERSIONS.split():
                table.append((f"cc-{code}-{v}", 1, f"{start} {_spoken(v)}"))
            table.append((f"cc-{code}", 2, start))
    for label in ("mit", "isc", "bsd-2-clause", "bsd-3-clause", "unlicense", "zlib", "cc0-1.0", "0bsd"):
        table.append((label, 1, SPDX.format(re.sub(r"[-.]", " ", label))))
    made = [Rule(label, priority, gate_words(x), pattern(x), x) for label, priority, x in table]
    return sorted(made, key=lambda r: r.priority)
