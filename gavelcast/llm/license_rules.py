"""Signatures of licences and rights notices, on normalised text.

Normalised text is lower case, with one blank between words and no other separator, so ``CC BY-NC 4.0`` reads
``cc by nc 4 0``. A rule has a label, a priority (higher wins), a key that every text it can match contains, and a regex
that matches whole words.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

#: Weight of a label in the score, by the priority of its best rule.
WEIGHTS = {1: 0.2, 2: 0.5, 3: 0.8, 4: 0.95}

V1, V2, V3 = (f"(?:version |v ?)?{n}(?: 0)?" for n in (1, 2, 3))
LATER = "(?: (?:only|or (?:any )?later(?: version)?|or (?:at your option )?any later version))?"

# label ; key ; full name ; short name
NAMED = f"""
apache-2.0 ; apache ; apache (?:software )?licen[sc]e {V2} ; apache {V2}
apache-1.1 ; apache ; apache (?:software )?licen[sc]e (?:version |v ?)?1 1 ; apache 1 1
apache-1.0 ; apache ; apache (?:software )?licen[sc]e {V1} ; apache 1 0
mit ; mit licen ; mit licen[sc]e ; mit
mit ; expat licen ; expat licen[sc]e ; expat
mit ; x11 licen ; (?:mit )?x11 licen[sc]e ; x11
mit-0 ; mit no attribution ; mit no attribution(?: licen[sc]e)? ; mit zero
bsd-2-clause ; bsd ; (?:simplified|freebsd|(?:bsd )?2 clause|two clause) (?:bsd )?licen[sc]e ; bsd 2 clause
bsd-3-clause ; bsd ; (?:new|modified|revised|(?:bsd )?3 clause|three clause) (?:bsd )?licen[sc]e ; bsd 3 clause
bsd-4-clause ; bsd ; (?:original|old|(?:bsd )?4 clause|four clause) (?:bsd )?licen[sc]e ; bsd 4 clause
0bsd ; bsd ; (?:zero clause bsd|bsd zero clause|0bsd)(?: licen[sc]e)? ; 0bsd
bsd ; bsd ; (?:bsd|berkeley software distribution)(?: style)? licen[sc]e ; bsd licen[sc]ed?
isc ; isc licen ; isc licen[sc]e ; isc
gpl-1.0 ; gnu ; gnu (?:gpl|general public licen[sc]e)(?: as published by the free software foundation)? {V1}{LATER} ; (?:gnu )?gpl ?v? ?1(?: 0)?{LATER}
gpl-2.0 ; gnu ; gnu (?:gpl|general public licen[sc]e)(?: as published by the free software foundation)? {V2}{LATER} ; (?:gnu )?gpl ?v? ?2(?: 0)?{LATER}
gpl-3.0 ; gnu ; gnu (?:gpl|general public licen[sc]e)(?: as published by the free software foundation)? {V3}{LATER} ; (?:gnu )?gpl ?v? ?3(?: 0)?{LATER}
gpl ; gnu ; gnu (?:gpl|general public licen[sc]e) ; gnu gpl
lgpl-2.0 ; gnu ; gnu (?:lgpl|library general public licen[sc]e) {V2}{LATER} ; lgpl ?v? ?2(?: 0)?{LATER}
lgpl-2.1 ; gnu ; gnu (?:lgpl|lesser general public licen[sc]e) (?:version |v ?)?2 1{LATER} ; lgpl ?v? ?2 1{LATER}
lgpl-3.0 ; gnu ; gnu (?:lgpl|lesser general public licen[sc]e) {V3}{LATER} ; lgpl ?v? ?3(?: 0)?{LATER}
lgpl ; gnu ; gnu (?:lgpl|(?:lesser|library) general public licen[sc]e) ; gnu lgpl
agpl-3.0 ; gnu ; gnu (?:agpl|affero general public licen[sc]e) {V3}{LATER} ; agpl ?v? ?3(?: 0)?{LATER}
agpl ; gnu ; gnu (?:agpl|affero general public licen[sc]e) ; gnu agpl
gfdl-1.2 ; gnu ; gnu (?:gfdl|fdl|free documentation licen[sc]e) (?:version |v ?)?1 2{LATER} ; gfdl 1 2
gfdl-1.3 ; gnu ; gnu (?:gfdl|fdl|free documentation licen[sc]e) (?:version |v ?)?1 3{LATER} ; gfdl 1 3
gfdl ; gnu ; gnu (?:gfdl|fdl|free documentation licen[sc]e) ; gnu gfdl
mpl-1.1 ; mozilla public ; mozilla public licen[sc]e (?:version |v ?)?1 1 ; mpl 1 1
mpl-2.0 ; mozilla public ; mozilla public licen[sc]e {V2} ; mpl 2 0
mpl ; mozilla public ; mozilla public licen[sc]e ; mozilla mpl
epl-1.0 ; eclipse public ; eclipse public licen[sc]e {V1} ; epl 1 0
epl-2.0 ; eclipse public ; eclipse public licen[sc]e {V2} ; epl 2 0
epl ; eclipse public ; eclipse public licen[sc]e ; eclipse epl
edl-1.0 ; eclipse distribution ; eclipse distribution licen[sc]e(?: {V1})? ; edl 1 0
cddl-1.0 ; common development and ; common development and distribution licen[sc]e(?: {V1})? ; cddl 1 0
cddl-1.1 ; common development and ; common development and distribution licen[sc]e (?:version |v ?)?1 1 ; cddl 1 1
cpl-1.0 ; common public licen ; common public licen[sc]e(?: {V1})? ; cpl 1 0
eupl-1.1 ; european union public ; european union public licen[sc]e (?:version |v ?)?1 1 ; eupl 1 1
eupl-1.2 ; european union public ; european union public licen[sc]e (?:version |v ?)?1 2 ; eupl 1 2
eupl ; european union public ; european union public licen[sc]e ; european eupl
artistic-1.0 ; artistic licen ; artistic licen[sc]e {V1} ; artistic 1 0
artistic-2.0 ; artistic licen ; artistic licen[sc]e {V2} ; artistic 2 0
artistic ; artistic licen ; artistic licen[sc]e ; perl artistic
bsl-1.0 ; boost software ; boost software licen[sc]e(?: {V1})? ; bsl 1 0
busl-1.1 ; business source ; business source licen[sc]e(?: (?:version |v ?)?1 1)? ; busl 1 1
sspl-1.0 ; server side public ; server side public licen[sc]e(?: {V1})? ; sspl 1 0
elastic-2.0 ; elastic licen ; elastic licen[sc]e(?: {V2})? ; elv 2 0
zlib ; zlib ; zlib(?: libpng)? licen[sc]e ; zlib
libpng ; libpng ; (?:png reference library|libpng) licen[sc]e ; libpng
openssl ; openssl ; openssl licen[sc]e ; openssl
python-2.0 ; python software foundation ; python software foundation licen[sc]e(?: {V2})? ; psf 2 0
php-3.01 ; php licen ; php licen[sc]e(?: (?:version |v ?)?3 0?1)? ; php 3 01
ruby ; ruby licen ; ruby licen[sc]e ; ruby
postgresql ; postgresql ; postgresql licen[sc]e ; postgresql
ofl-1.1 ; open font licen ; (?:sil )?open font licen[sc]e(?: (?:version |v ?)?1 1)? ; ofl 1 1
unlicense ; unlicen ; the unlicen[sc]e ; unlicense
wtfpl ; wtfpl ; wtfpl(?: {V2})? ; wtfpl
cc0-1.0 ; cc0 ; (?:creative commons )?cc0(?: (?:version |v ?)?1 0)?(?: universal)?(?: public domain dedication)? ; cc0 1 0
cc0-1.0 ; creative commons ; creative commons (?:zero|public domain dedication)(?: {V1})? ; cc zero
odbl-1.0 ; database licen ; open (?:data commons open )?database licen[sc]e(?: {V1})? ; odbl 1 0
odc-by-1.0 ; data commons ; open data commons attribution licen[sc]e(?: {V1})? ; odc by 1 0
pddl-1.0 ; data commons ; (?:open data commons )?public domain dedication and licen[sc]e(?: {V1})? ; pddl 1 0
ogl-uk-3.0 ; open government licen ; open government licen[sc]e {V3} ; ogl uk 3 0
ogl-uk-2.0 ; open government licen ; open government licen[sc]e {V2} ; ogl uk 2 0
ogl-uk ; open government licen ; open government licen[sc]e ; ogl uk
etalab-2.0 ; ouverte ; licence ouverte(?: open licence)?(?: {V2})? ; etalab 2 0
dl-de-by-2.0 ; datenlizenz ; datenlizenz deutschland namensnennung(?: (?:version )?2 0)? ; dl de by 2 0
ms-pl ; microsoft public ; microsoft public licen[sc]e ; ms pl
ms-rl ; microsoft reciprocal ; microsoft reciprocal licen[sc]e ; ms rl
upl-1.0 ; universal permissive ; universal permissive licen[sc]e(?: {V1})? ; upl 1 0
ncsa ; university of illinois ; university of illinois(?: ncsa)? open source licen[sc]e ; ncsa
afl-3.0 ; academic free ; academic free licen[sc]e(?: {V3})? ; afl 3 0
osl-3.0 ; open software licen ; open software licen[sc]e(?: {V3})? ; osl 3 0
lppl-1.3c ; latex project ; latex project public licen[sc]e(?: (?:version |v ?)?1 3c?)? ; lppl 1 3c
openrail ; rail ; (?:creativeml )?open ?rail(?: [a-z])?(?: licen[sc]e)? ; openrail
"""

# Creative Commons: elements of the short form and their full names.
ELEMENTS = (
    ("by", "attribution"), ("by-sa", "attribution share ?alike"), ("by-nd", "attribution no ?deriv(?:ative)?s?(?: works)?"),
    ("by-nc", "attribution non ?commercial"), ("by-nc-sa", "attribution non ?commercial share ?alike"),
    ("by-nc-nd", "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"),
)
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# label ; priority ; key ; regex
NOTICES = """
reserved ; 2 ; reserved ; all rights (?:are )?reserved(?: worldwide)?
reserved ; 2 ; reserved ; (?:some|no) rights reserved
reserved ; 2 ; vorbehalten ; alle rechte vorbehalten
reserved ; 2 ; droits ; tous droits réservés
reserved ; 2 ; derechos ; (?:todos los|reservados todos los) derechos(?: reservados)?
copyright ; 2 ; copyright ; copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
copyright ; 1 ; copyright ; copyright (?:notice|holder|holders|owner|owners)
copyright ; 1 ; copyright ; (?:protected by|subject to) copyright
copyright ; 2 ; © ; © (?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?
public-domain ; 3 ; public domain ; (?:dedicated to|released (?:in)?to|placed in|in) the public domain
public-domain ; 2 ; public domain ; public domain (?:mark|work|dedication)
public-domain ; 2 ; gemeinfrei ; gemeinfrei
public-domain ; 2 ; domaine public ; (?:dans )?le domaine public
public-domain ; 2 ; dominio público ; (?:de|en) dominio público
proprietary ; 3 ; proprietary ; (?:confidential and proprietary|proprietary and confidential)
proprietary ; 2 ; proprietary ; proprietary (?:software|licen[sc]e|information)
eula ; 3 ; end user licen ; end user licen[sc]e agreement
no-redistribution ; 3 ; redistribut ; (?:may not be|no) redistribut(?:ed|ion)(?: without (?:the )?(?:prior )?(?:written )?permission)?
no-redistribution ; 3 ; permission ; reproduction (?:in whole or in part )?without (?:prior )?(?:written )?permission is (?:strictly )?prohibited
permissive-text ; 3 ; permission ; permission is hereby granted free of charge to any person obtaining a copy
permissive-text ; 3 ; permitted ; redistribution and use in source and binary forms with or without modification are permitted
permissive-text ; 3 ; permission ; permission to use copy modify and (?:or )?distribute this software
copyleft-text ; 3 ; redistribute ; you can redistribute it and or modify it under the terms of
copyleft-text ; 3 ; copyleft ; copyleft(?: licen[sc]ed?)?
warranty ; 2 ; warrant ; without (?:any )?warranty(?: of any kind)?
warranty ; 2 ; warrant ; without warranties or conditions of any kind
warranty ; 2 ; provided as is ; provided as is
non-commercial ; 2 ; commercial ; (?:for )?non ?commercial use only
non-commercial ; 2 ; commercial ; (?:not for|no) commercial use
grant ; 1 ; licen ; (?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of )?(?:the |an? )?(?:[^ ]+ ){0,4}licen[sc]e
grant ; 1 ; licen ; (?:this|the) (?:work|text|file|article|document|content) is licen[sc]ed under
grant ; 1 ; lizenz ; (?:lizenziert unter|unter der lizenz|veröffentlicht unter)
grant ; 1 ; licence ; (?:sous licence|sous la licence)
grant ; 1 ; licencia ; (?:bajo (?:la |una )?licencia|con licencia)
"""

GRANTED = "(?:licen[sc]ed|released|distributed|available|published|provided) under (?:the )?(?:terms of )?(?:the |a )?"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    key: str
    regex: str


def _lines(table: str):
    return [tuple(x.strip() for x in line.split(" ; ")) for line in table.strip().splitlines()]


def _literal(short: str) -> str:
    """Something that every match of a short name contains."""
    return short if re.fullmatch("[a-z0-9 ]+", short) else re.match(r"(?:\(\?:gnu \)\?)?([a-z]+)", short)[1]


def rules() -> list[Rule]:
    """All rules, in the order that decides between equals."""
    out = []
    for label, key, name, short in _lines(NAMED):
        out.append(Rule(label, 4, "spdx licen", f"spdx licen[sc]e identifier {short}"))
        out.append(Rule(label, 4, key, GRANTED + name))
        out.append(Rule(label, 3, key, f"(?:the )?{name}"))
        # A short name of one word may be a word of some language, so it counts in a tag only.
        if " " in short:
            out.append(Rule(label, 2, _literal(short), short))
    for elements, name in ELEMENTS:
        words = elements.replace("-", " ")
        for version in CC_VERSIONS:
            number = version.replace(".", " ")
            out.append(Rule(f"cc-{elements}-{version}", 4, "cc by", f"cc {words} {number}(?: [a-z]{{2}})?"))
            out.append(Rule(f"cc-{elements}-{version}", 4, "creative commons", f"creative commons {name} {number}(?: (?:international|unported|generic))?(?: licen[sc]e)?"))
            out.append(Rule(f"cc-{elements}-{version}", 4, "creativecommons", f"creativecommons org licen[sc]es {words} {number}"))
        out.append(Rule(f"cc-{elements}", 3, "cc by", f"cc {words}(?: licen[sc]e)?"))
        out.append(Rule(f"cc-{elements}", 3, "creative commons", f"creative commons {name}(?: (?:international|unported|generic))?(?: licen[sc]e)?"))
        out.append(Rule(f"cc-{elements}", 3, "creativecommons", f"creativecommons org licen[sc]es {words}"))
    out.append(Rule("cc", 2, "creative commons", "creative commons(?: licen[sc]e)?"))
    out.append(Rule("cc0-1.0", 4, "creativecommons", "creativecommons org publicdomain zero 1 0"))
    out += [Rule(label, int(priority), key, regex) for label, priority, key, regex in _lines(NOTICES)]
    return out
