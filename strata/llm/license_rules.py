"""The signature rules of the license scan.

A rule is a regular expression over normalised words (lower case, one blank between
words; ``2.0`` reads ``2 0``).  Families are written by hand; those with versions are
spelled out for each version.  ``{v}`` stands for the version.  ``TEXTS`` are sentences of
licence texts and file headers.  Every match of a rule
contains the rule's keyword, and every keyword contains or accompanies an anchor:
a text without any anchor cannot match any rule.
"""

from __future__ import annotations

from dataclasses import dataclass

# every rule's matches contain one of these
ANCHORS = ("licen", "gpl", "cc by", "cc0", "creative commons", "public domain", "copyright", "reserved", "permission",
           "redistribution", "warrant", "wtfpl", "proprietary", "copyleft", "advertising materials", "creativecommons", "written consent", "anyone is free to copy",
           "same terms as perl", "altered source versions")


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    regex: str
    priority: int  # of rules that match the same words the one with the smallest number stands
    weight: float  # how far a match is trusted, 0 to 1


def version(v: str) -> str:
    """``2.0`` as words: ``2 0``, ``v2 0``, ``2``."""
    major, minor = v.split(".")
    return f"v?{major} {minor}" if minor != "0" else f"v?{major}(?: 0)?"


GNU = {
    "GPL": "general public licen[sc]e",
    "LGPL": "(?:lesser|library) general public licen[sc]e",
    "AGPL": "affero general public licen[sc]e",
}
GNU_VERSIONS = {"GPL": ("1.0", "2.0", "3.0"), "LGPL": ("2.0", "2.1", "3.0"), "AGPL": ("1.0", "3.0")}
LATER = "(?: of the licen[sc]e)?(?: or)?(?: at your option)?(?: or)? any later(?: version)?"

CC_NAMES = {
    "by": "attribution",
    "by sa": "attribution sharealike",
    "by nd": "attribution noderivatives",
    "by nc": "attribution noncommercial",
    "by nc sa": "attribution noncommercial sharealike",
    "by nc nd": "attribution noncommercial noderivatives",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# label, keyword, versions, expressions
VERSIONED = (
    ("Apache", "apache", ("1.0", "1.1", "2.0"), (
        "apache(?: software)? licen[sc]e(?: version)? {v}",
        "licen[sc]ed under(?: the)? apache(?: version)? {v}",
        "licen[sc]e identifier apache {v}",
    )),
    ("MPL", "mozilla", ("1.0", "1.1", "2.0"), (
        "mozilla public licen[sc]e(?: version)? {v}",
        "mozilla public licen[sc]e mpl(?: version)? {v}",
    )),
    ("EPL", "eclipse", ("1.0", "2.0"), (
        "eclipse public licen[sc]e(?: version)? {v}",
        "eclipse public licen[sc]e epl(?: version)? {v}",
    )),
    ("CDDL", "common development", ("1.0", "1.1"), (
        "common development and distribution licen[sc]e(?: cddl)?(?: version)? {v}",
    )),
    ("EUPL", "european union", ("1.0", "1.1", "1.2"), (
        "european union public licen[sc]e(?: version)? {v}",
    )),
    ("GFDL", "free documentation", ("1.1", "1.2", "1.3"), (
        "gnu free documentation licen[sc]e(?: version)? {v}",
    )),
    ("OSL", "open software", ("1.0", "2.0", "2.1", "3.0"), (
        "open software licen[sc]e(?: version)? {v}",
    )),
    ("AFL", "academic free", ("1.2", "2.0", "2.1", "3.0"), (
        "academic free licen[sc]e(?: version)? {v}",
    )),
    ("Artistic", "artistic", ("1.0", "2.0"), (
        "(?:perl )?artistic licen[sc]e(?: version)? {v}",
    )),
    ("OFL", "open font", ("1.0", "1.1"), (
        "(?:sil )?open font licen[sc]e(?: version)? {v}",
    )),
    ("BSL", "boost", ("1.0",), (
        "boost software licen[sc]e(?: version)? {v}",
    )),
    ("ZPL", "zope", ("1.1", "2.0", "2.1"), (
        "zope public licen[sc]e(?: zpl)?(?: version)? {v}",
    )),
    ("LPPL", "latex", ("1.0", "1.1", "1.2", "1.3"), (
        "latex project public licen[sc]e(?: version)? {v}",
    )),
    ("MS-PL-version", "microsoft public", ("1.0",), (
        "microsoft public licen[sc]e(?: version)? {v}",
    )),
)

# label, keyword, expressions
PLAIN = (
    ("Apache", "apache", ("apache(?: software)? licen[sc]e", "licen[sc]ed under(?: the)? apache(?! licen)")),
    ("MIT", "mit", ("(?:the )?mit licen[sc]e", "licen[sc]ed under(?: the)? mit", "licen[sc]e identifier mit", "mit expat licen[sc]e")),
    ("MIT", "permission", ("permission is hereby granted free of charge to any person obtaining a copy",)),
    ("MIT-0", "no attribution", ("mit no attribution licen[sc]e", "mit licen[sc]e no attribution")),
    ("X11", "x11", ("x11 licen[sc]e", "mit x11 licen[sc]e", "x consortium licen[sc]e x11")),
    ("ISC", "isc", ("isc licen[sc]e", "licen[sc]ed under(?: the)? isc", "licen[sc]e identifier isc")),
    ("ISC", "permission", ("permission to use copy modify and or distribute this software for any purpose",)),
    ("BSD", "bsd", ("bsd(?: style)? licen[sc]e", "licen[sc]ed under(?: the)? bsd", "bsd licen[sc]ed")),
    ("BSD-2-Clause", "bsd", ("(?:simplified|freebsd) bsd licen[sc]e", "bsd 2 clause licen[sc]e", "2 clause bsd licen[sc]e", "two clause bsd licen[sc]e")),
    ("BSD-3-Clause", "bsd", ("(?:new|modified|revised) bsd licen[sc]e", "bsd 3 clause licen[sc]e", "3 clause bsd licen[sc]e", "three clause bsd licen[sc]e")),
    ("BSD-4-Clause", "bsd", ("(?:original|old) bsd licen[sc]e", "bsd 4 clause licen[sc]e", "4 clause bsd licen[sc]e")),
    ("BSD", "redistribution", ("redistribution and use in source and binary forms with or without modification(?: are permitted)?",)),
    ("Zlib", "zlib", ("zlib(?: libpng)? licen[sc]e", "licen[sc]ed under(?: the)? zlib")),
    ("Zlib", "warranty", ("provided as is without any express or implied warranty",)),
    ("Warranty-disclaimer", "warranty", ("without warranty of any kind", "without warranties or conditions of any kind warranty", "absolutely no warranty")),
    ("Unlicense", "unlicense", ("(?:the )?unlicense", "released under the unlicense")),
    ("Public-domain", "public domain", ("public domain", "released into the public domain", "dedicated to the public domain", "free and unencumbered software released into the public domain")),
    ("CC0-1.0", "cc0", ("cc0", "cc0 1 0(?: universal)?", "creative commons cc0", "creative commons cc0 1 0(?: universal)?", "creative commons zero cc0")),
    ("CC", "creative commons", ("creative commons", "creative commons licen[sc]e", "licen[sc]ed under(?: a| the)? creative commons(?: licen[sc]e)?")),
    ("WTFPL", "wtfpl", ("wtfpl", "wtfpl licen[sc]e", "licen[sc]ed under(?: the)? wtfpl")),
    ("GPL", "gpl", ("gpl", "gnu gpl", "gpl licen[sc]ed", "licen[sc]ed under(?: the)?(?: gnu)? gpl")),
    ("LGPL", "lgpl", ("lgpl", "gnu lgpl", "licen[sc]ed under(?: the)?(?: gnu)? lgpl")),
    ("AGPL", "agpl", ("agpl", "gnu agpl", "licen[sc]ed under(?: the)?(?: gnu)? agpl")),
    ("GPL", "general public", ("(?:gnu )?general public licen[sc]e",)),
    ("LGPL", "general public", ("(?:gnu )?(?:lesser|library) general public licen[sc]e",)),
    ("AGPL", "general public", ("(?:gnu )?affero general public licen[sc]e",)),
    ("MPL", "mozilla", ("mozilla public licen[sc]e",)),
    ("EPL", "eclipse", ("eclipse public licen[sc]e",)),
    ("CDDL", "common development", ("common development and distribution licen[sc]e",)),
    ("CPL", "common public", ("common public licen[sc]e(?: version)?(?: 1 0)?",)),
    ("IPL", "ibm public", ("ibm public licen[sc]e(?: version)?(?: 1 0)?",)),
    ("EUPL", "european union", ("european union public licen[sc]e",)),
    ("GFDL", "free documentation", ("(?:gnu )?free documentation licen[sc]e",)),
    ("Artistic", "artistic", ("(?:perl )?artistic licen[sc]e",)),
    ("OFL", "open font", ("(?:sil )?open font licen[sc]e",)),
    ("BSL", "boost", ("boost software licen[sc]e",)),
    ("PSF", "python software", ("python software foundation licen[sc]e(?: version)?(?: 2)?",)),
    ("PHP", "php", ("php licen[sc]e(?: version)?(?: 3 0[01]?)?",)),
    ("Ruby", "ruby", ("ruby licen[sc]e", "ruby s licen[sc]e")),
    ("OpenSSL", "openssl", ("openssl licen[sc]e",)),
    ("MS-PL", "microsoft public", ("microsoft public licen[sc]e",)),
    ("MS-RL", "microsoft reciprocal", ("microsoft reciprocal licen[sc]e",)),
    ("ODbL", "open database", ("open database licen[sc]e(?: odbl)?(?: 1 0)?",)),
    ("ODC-By", "open data commons", ("open data commons attribution licen[sc]e",)),
    ("PDDL", "open data commons", ("open data commons public domain dedication and licen[sc]e",)),
    ("BUSL-1.1", "business source", ("business source licen[sc]e(?: 1 1)?",)),
    ("SSPL-1.0", "server side", ("server side public licen[sc]e(?: version)?(?: 1)?",)),
    ("Elastic-2.0", "elastic", ("elastic licen[sc]e(?: v?2(?: 0)?)?",)),
    ("CeCILL", "cecill", ("cecill(?: free software)? licen[sc]e", "licen[sc]e cecill")),
    ("Beerware", "beer", ("beer ?ware licen[sc]e", "the beer ware licen[sc]e")),
    ("JSON", "json", ("json licen[sc]e", "shall be used for good not evil json licen[sc]e")),
    ("Copyright-notice", "copyright", ("copyright(?: c)? (?:19|20)[0-9]{2}(?: (?:19|20)[0-9]{2})?", "copyright(?: c)? by", "copyright holders?", "copyright notice")),
    ("Reserved", "reserved", ("all rights reserved", "some rights reserved", "no rights reserved")),
    ("Proprietary", "proprietary", ("proprietary and confidential", "proprietary licen[sc]e", "proprietary software")),
    ("Copyleft", "copyleft", ("copyleft", "copyleft licen[sc]e")),
    ("Licensed", "licen", ("all licen[sc]es", "licen[sc]e agreement", "end user licen[sc]e agreement", "terms of (?:this|the) licen[sc]e", "licen[sc]ed under the terms")),
    ("No-permission", "permission", ("without (?:prior )?(?:written )?permission", "reproduction without permission is prohibited", "used (?:by|with) permission", "reprinted (?:by|with) permission")),
)


# sentences of licence texts and file headers: label, keyword, expressions
TEXTS = (
    ("Apache", "applicable law", ("unless required by applicable law or agreed to in writing software distributed under the licen[sc]e is distributed on an as is basis",)),
    ("Apache", "except in compliance", ("(?:you )?may not use this file except in compliance with the licen[sc]e",)),
    ("Apache", "apache org", ("apache org licen[sc]es(?: licen[sc]e 2 0)?(?: txt| html)?",)),
    ("Apache", "contributor licen", ("licen[sc]ed to the apache software foundation asf under one or more contributor licen[sc]e agreements",)),
    ("Apache", "perpetual", ("perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) licen[sc]e",)),
    ("MIT", "permission notice", ("the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software",)),
    ("MIT", "noninfringement", ("warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",)),
    ("MIT", "opensource org", ("opensource org licen[sc]es? mit",)),
    ("BSD", "source code must retain", ("redistributions of source code must retain the above copyright notice(?: this list of conditions and the following disclaimer)?",)),
    ("BSD", "in binary form must", ("redistributions in binary form must reproduce the above copyright notice(?: this list of conditions and the following disclaimer)?",)),
    ("BSD-3-Clause", "endorse or promote", ("endorse or promote products derived from this software without specific prior written permission",)),
    ("BSD-4-Clause", "advertising materials", ("all advertising materials mentioning features or use of this software must display the following acknowledge?ment",)),
    ("BSD", "bsd style", ("(?:governed|covered) by a bsd style licen[sc]e(?: that can be found in the licen[sc]e file)?",)),
    ("ISC", "appear in all copies", ("provided that the above copyright notice and this permission notice appear in all copies",)),
    ("HPND", "without fee", ("permission to use copy modify and distribute this software and its documentation for any purpose(?: and)? without fee is hereby granted",)),
    ("GPL", "free software you can", ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[sc]e",)),
    ("GPL", "you should have received", ("you should have received a copy of the gnu general public licen[sc]e(?: along with this (?:program|software))?",)),
    ("GPL", "hope that it will", ("distributed in the hope that it will be useful but without any warranty(?: without even the implied warranty of merchantability or fitness for a particular purpose)?",)),
    ("GPL", "gnu org", ("gnu org licen[sc]es(?: gpl)?(?: html| txt)?", "gnu org copyleft gpl(?: html)?")),
    ("GPL", "corresponding source", ("corresponding source under the terms of this licen[sc]e",)),
    ("GPL", "classpath exception", ("gpl (?:v?2 )?(?:with|w) (?:the )?classpath exception",)),
    ("LGPL", "this library is free", ("this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[sc]e",)),
    ("LGPL", "you should have received", ("you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e(?: along with this (?:library|program))?",)),
    ("AGPL", "you should have received", ("you should have received a copy of the gnu affero general public licen[sc]e(?: along with this program)?",)),
    ("AGPL", "affero", ("under the terms of the gnu affero general public licen[sc]e",)),
    ("MPL", "source code form", ("this source code form is subject to the terms of the mozilla public licen[sc]e",)),
    ("MPL", "contents of this file", ("the contents of this file are subject to the mozilla public licen[sc]e",)),
    ("NPL", "netscape", ("netscape public licen[sc]e(?: version)?(?: 1 [01])?", "the contents of this file are subject to the netscape public licen[sc]e")),
    ("EPL", "accompanying materials", ("this program and the accompanying materials are made available under the terms of the eclipse public licen[sc]e",)),
    ("CDDL", "contents of this file", ("the contents of this file are subject to the terms of the common development and distribution licen[sc]e",)),
    ("Unlicense", "compiled binary", ("anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary(?: for any purpose commercial or non commercial and by any means)?",)),
    ("Unlicense", "unlicense org", ("(?:please refer to )?(?:http )?unlicense org",)),
    ("Public-domain", "public domain", ("(?:place[sd]?|put) (?:this|it|the) (?:work |code |software |file )?(?:in|into) the public domain",
                                        "(?:is|are) (?:in|within) the public domain", "public domain dedication", "public domain mark(?: 1 0)?", "not subject to copyright protection and (?:is|are) in the public domain")),
    ("Public-domain", "copyright to this source", ("the authors? disclaims? copyright to this source code(?: and places? it in the public domain)?",)),
    ("Zlib", "altered source", ("altered source versions must be plainly marked as such and must not be misrepresented as being the original software",)),
    ("Zlib", "commercial applications", ("permission is granted to anyone to use this software for any purpose including commercial applications(?: and to alter it and redistribute it freely)?",)),
    ("BSL", "boost org", ("boost org licen[sc]e 1 0(?: txt)?",)),
    ("BSL", "accompanying file", ("see accompanying file licen[sc]e 1 0 txt",)),
    ("BSL", "any person or", ("permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software",)),
    ("OFL", "reserved font", ("with reserved font names?",)),
    ("OFL", "font software", ("this font software is licen[sc]ed under the sil open font licen[sc]e",)),
    ("GFDL", "this document under", ("permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e",)),
    ("Artistic", "same terms as perl", ("under the same terms as perl(?: itself)?",)),
    ("WTFPL", "what the", ("do what the [a-z]{1,8} you want to public licen[sc]e",)),
    ("CC", "creativecommons org", ("creativecommons org licen[sc]es [a-z]{2}(?: (?:nc|nd|sa)){0,2}(?: [1-4] [05])?",)),
    ("CC0-1.0", "creativecommons org", ("creativecommons org publicdomain zero(?: 1 0)?",)),
    ("CC0-1.0", "neighboring rights", ("waived all copyright and related (?:or|and) neighboring rights",)),
    ("CC", "this work is licen", ("this work is licen[sc]ed under (?:a|the) creative commons",)),
    ("CC-BY-SA", "text is available", ("text is available under the creative commons attribution share ?alike licen[sc]e",)),
    ("BUSL-1.1", "change date", ("change date [a-z0-9 ]{1,30} change licen[sc]e",)),
    ("Commons-Clause", "commons clause", ("commons clause licen[sc]e condition(?: v?1 0)?",)),
    ("Proprietary", "confidential", ("this (?:document|software|file) contains (?:confidential and proprietary|proprietary and confidential) information",)),
    ("Proprietary", "trade secret", ("proprietary (?:and|or) trade secret information", "trade secrets? and proprietary information")),
    ("Proprietary", "reverse engineer", ("may not reverse engineer decompile or disassemble the licen[sc]ed software",)),
    ("Licensed", "see the licen", ("see the licen[sc]e for the specific language governing permissions(?: and limitations under the licen[sc]e)?", "see the licen[sc]e file(?: for (?:details|more information|licen[sc]e rights))?")),
    ("Licensed", "by using", ("by using this (?:software|site|website|file) you agree to (?:the|these|this) (?:terms of )?licen[sc]e",)),
    ("Licensed", "non exclusive", ("(?:limited )?non exclusive (?:non transferable )?(?:revocable )?licen[sc]e",)),
    ("Licensed", "royalty free", ("royalty free licen[sc]e", "worldwide royalty free(?: non exclusive)? licen[sc]e")),
    ("Licensed", "dual licen", ("dual licen[sc]ed(?: under)?",)),
    ("Licensed", "spdx", ("spdx licen[sc]e identifier",)),
    ("Licensed", "open source licen", ("(?:an )?open source licen[sc]e",)),
    ("Licensed", "sublicen", ("right to sublicen[sc]e", "use copy modify merge publish distribute sublicen[sc]e and or sell copies")),
    ("No-permission", "written consent", ("without the (?:express |prior )?written consent of the (?:copyright (?:holder|owner)|publisher|author)",)),
    ("No-permission", "written permission", ("without the (?:express |prior )?written permission of the (?:copyright (?:holder|owner)|publisher|author)",)),
    ("No-permission", "may not be reproduced", ("may not be reproduced(?: in any form)? without (?:prior )?(?:written )?permission",)),
    ("No-permission", "may be reproduced", ("no part of this (?:publication|book|document|work) may be reproduced [a-z ]{0,120}permission",)),
    ("No-permission", "unauthori", ("unauthori[sz]ed (?:copying|reproduction|use|distribution)(?: or (?:copying|reproduction|use|distribution))? of (?:this|the) copyright(?:ed)? (?:work|material)",)),
    ("Copyright-notice", "copyright", ("protected by copyright(?: law)?", "copyright infringement", "copyrighted (?:work|material)", "international copyright (?:law|treaties)", "u s copyright law",
                                       "retain (?:this|the above) copyright notice", "copyright and (?:related|other) rights")),
    ("Crown-copyright", "crown copyright", ("crown copyright(?: and database rights?)?(?: (?:19|20)[0-9]{2})?",)),
    ("OGL", "open government", ("open government licen[sc]e(?: for public sector information)?(?: v?[123](?: 0)?)?",)),
    ("Warranty-disclaimer", "warranty", ("as is without warranty(?: of any kind)?(?: either)?(?: express(?:ed)? or implied)?", "makes no warranty(?: express or implied)?", "disclaims? (?:all|any) (?:express or implied )?warranty",
                                         "implied warranty of merchantability", "this software comes with no warranty", "provided with no warranty")),
    ("Warranty-disclaimer", "warranties", ("disclaims? (?:all|any) (?:express or implied )?warranties", "(?:any )?express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed")),
)

# further licences by name: label, keyword, name
NAMED = (
    ("QPL-1.0", "q public", "q public licen[sc]e(?: version)?(?: 1 0)?"),
    ("APSL", "apple public", "apple public source licen[sc]e(?: version)?(?: [12] [012])?"),
    ("RPL", "reciprocal public", "reciprocal public licen[sc]e(?: version)?(?: 1 [15])?"),
    ("SPL", "sun public", "sun public licen[sc]e(?: version)?(?: 1 0)?"),
    ("SISSL", "sun industry", "sun industry standards source licen[sc]e"),
    ("NASA-1.3", "nasa open", "nasa open source agreement licen[sc]e"),
    ("NCSA", "illinois", "university of illinois(?: ncsa)? open source licen[sc]e"),
    ("PostgreSQL", "postgresql", "postgresql licen[sc]e"),
    ("Vim", "vim", "vim licen[sc]e"),
    ("FTL", "freetype", "freetype(?: project)? licen[sc]e"),
    ("IJG", "jpeg group", "independent jpeg group licen[sc]e"),
    ("Libpng", "png", "(?:png reference library|libpng) licen[sc]e"),
    ("curl", "curl", "curl licen[sc]e"),
    ("ICU", "icu", "icu licen[sc]e"),
    ("Unicode-DFS", "unicode", "unicode licen[sc]e(?: agreement)?(?: data files and software)?"),
    ("W3C", "w3c", "w3c (?:software(?: notice and| and document)?|document) licen[sc]e"),
    ("EFL", "eiffel", "eiffel forum licen[sc]e(?: version)?(?: [12])?"),
    ("MulanPSL", "mulan", "mulan (?:permissive software|psl) licen[sc]e(?: version)?(?: [12])?"),
    ("UPL-1.0", "universal permissive", "universal permissive licen[sc]e(?: v?1 0)?"),
    ("BlueOak", "blue oak", "blue oak model licen[sc]e(?: 1 0 0)?"),
    ("Parity", "parity", "parity public licen[sc]e(?: 7 0 0)?"),
    ("PolyForm", "polyform", "polyform (?:noncommercial|small business|shield|strict) licen[sc]e(?: 1 0 0)?"),
    ("RPSL", "realnetworks", "realnetworks public source licen[sc]e"),
    ("Watcom", "watcom", "(?:sybase )?open watcom public licen[sc]e"),
    ("OCLC", "oclc", "oclc research public licen[sc]e"),
    ("LiLiQ", "quebec", "quebec (?:free and open source|permissive|reciprocity) licen[sc]e"),
    ("Sleepycat", "sleepycat", "sleepycat licen[sc]e"),
    ("OLDAP", "openldap", "openldap public licen[sc]e(?: version)?(?: 2 [0-9])?"),
    ("Intel", "intel", "intel (?:open source|simplified software) licen[sc]e"),
    ("Nokia", "nokia", "nokia open source licen[sc]e"),
    ("CPAL-1.0", "attribution licen", "common public attribution licen[sc]e(?: version)?(?: 1 0)?"),
    ("FreeImage", "freeimage", "freeimage public licen[sc]e"),
    ("GL2PS", "gl2ps", "gl2ps licen[sc]e"),
    ("SGI-B", "sgi free", "sgi free software licen[sc]e b"),
    ("TCL", "tcl", "tcl tk licen[sc]e"),
    ("Xnet", "x net", "x net licen[sc]e"),
    ("NPOSL", "non profit", "non profit open software licen[sc]e"),
    ("Hippocratic", "hippocratic", "hippocratic licen[sc]e(?: version)?(?: [23] [01])?"),
    ("OpenRAIL", "openrail", "(?:creativeml |bigscience )?openrail(?: m)? licen[sc]e"),
    ("CDLA", "community data", "community data licen[sc]e agreement(?: permissive| sharing)?"),
    ("FAL", "free art", "free art licen[sc]e(?: 1 [23])?"),
    ("CERN-OHL", "cern open", "cern open hardware licen[sc]e(?: version)?(?: [12])?(?: [012])?"),
    ("TAPR-OHL", "tapr", "tapr open hardware licen[sc]e"),
    ("Solderpad", "solderpad", "solderpad hardware licen[sc]e"),
    ("Etalab", "etalab", "(?:etalab )?open licen[sc]e etalab"),
    ("DL-DE", "datenlizenz", "datenlizenz deutschland licen[sc]e"),
)


def build_rules() -> list[Rule]:
    made: list[tuple[str, str, str, int, float]] = []
    for name, title in GNU.items():
        for v in GNU_VERSIONS[name]:
            short = f"(?:gnu )?{name.lower()}(?: licen[sc]e)?(?: version)? {version(v)}"
            long = f"(?:gnu )?{title}(?: {name.lower()})?(?: as published by the free software foundation)?(?: either)?(?: version)? {version(v)}"
            for keyword, text in ((name.lower(), short), ("general public", long)):
                made.append((f"{name}-{v}-or-later", keyword, text + LATER, 0, 1.0))
                made.append((f"{name}-{v}", keyword, text, 1, 0.95))
                made.append((f"{name}-{v}", keyword, f"licen[sc]ed under(?: the)? {text}", 1, 1.0))
    for parts, title in CC_NAMES.items():
        label = "CC-" + parts.upper().replace(" ", "-")
        for v in CC_VERSIONS:
            made.append((f"{label}-{v}", "cc by", f"cc {parts}(?: licen[sc]e)?(?: version)? {version(v)}", 1, 0.95))
            made.append((f"{label}-{v}", "creative commons", f"creative commons {title}(?: licen[sc]e)?(?: version)? {version(v)}", 1, 1.0))
            made.append((f"{label}-{v}", "creative commons", f"creative commons {title} {version(v)}(?: international| unported| generic)(?: licen[sc]e)?", 0, 1.0))
        made.append((label, "cc by", f"cc {parts}", 3, 0.8))
        made.append((label, "creative commons", f"creative commons {title}(?: licen[sc]e)?", 3, 0.9))
    for name, keyword, versions, texts in VERSIONED:
        for v in versions:
            made += [(f"{name}-{v}", keyword, text.format(v=version(v)), 1, 1.0) for text in texts]
    made += [(name, keyword, text, 4, 0.7) for name, keyword, texts in PLAIN for text in texts]
    made += [(name, keyword, text, 2, 0.9) for name, keyword, texts in TEXTS for text in texts]
    made += [(name, keyword, text, 4, 0.8) for name, keyword, text in NAMED]
    return [Rule(*m) for m in made]


RULES = build_rules()
