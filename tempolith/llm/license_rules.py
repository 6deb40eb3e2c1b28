"""Signature rules for licence scans, in the order in which they are tried.

A line is ``label | kind | keyword | pattern``. Patterns are regular expressions over lower-case words parted by one
space (a "word" is a run of letters and digits, so ``CC BY-NC 4.0`` reads ``cc by nc 4 0``); a rule is only tried on
passages that hold its keyword at the start of a word. Patterns have no capturing group and cover at most
``licenses.REACH`` words. Of the kinds in ``KINDS`` the earlier ones win over the later ones.
"""

from __future__ import annotations

from typing import NamedTuple

#: Kind -> (priority, confidence). An identifier or a sentence of the licence itself outranks a mention of its name.
KINDS = {"tag": (1, 1.0), "text": (2, 0.95), "url": (3, 0.95), "grant": (4, 0.9), "name": (5, 0.7), "hint": (6, 0.3)}

#: The phrases that every scan must report, all places of them; they are rules like others and never suppressed.
BASE = """
mit | grant | under the mit license | under the mit license
apache-2 | name | apache license version 2 | apache license version 2
cc-by-nc | name | cc by nc | cc by nc
"""

RULES = r"""
mit | tag | spdx license identifier | spdx license identifier mit
mit-0 | tag | spdx license identifier | spdx license identifier mit 0
apache-2.0 | tag | spdx license identifier | spdx license identifier apache 2 0
apache-1.1 | tag | spdx license identifier | spdx license identifier apache 1 1
bsd-2-clause | tag | spdx license identifier | spdx license identifier bsd 2 clause
bsd-3-clause | tag | spdx license identifier | spdx license identifier bsd 3 clause
bsd-4-clause | tag | spdx license identifier | spdx license identifier bsd 4 clause
0bsd | tag | spdx license identifier | spdx license identifier 0bsd
isc | tag | spdx license identifier | spdx license identifier isc
zlib | tag | spdx license identifier | spdx license identifier zlib
unlicense | tag | spdx license identifier | spdx license identifier unlicense
wtfpl | tag | spdx license identifier | spdx license identifier wtfpl
gpl-2.0-only | tag | spdx license identifier | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | tag | spdx license identifier | spdx license identifier gpl 2 0 or later
gpl-3.0-only | tag | spdx license identifier | spdx license identifier gpl 3 0(?: only)?
gpl-3.0-or-later | tag | spdx license identifier | spdx license identifier gpl 3 0 or later
lgpl-2.1-only | tag | spdx license identifier | spdx license identifier lgpl 2 1(?: only)?
lgpl-2.1-or-later | tag | spdx license identifier | spdx license identifier lgpl 2 1 or later
lgpl-3.0-only | tag | spdx license identifier | spdx license identifier lgpl 3 0(?: only)?
lgpl-3.0-or-later | tag | spdx license identifier | spdx license identifier lgpl 3 0 or later
agpl-3.0-only | tag | spdx license identifier | spdx license identifier agpl 3 0(?: only)?
agpl-3.0-or-later | tag | spdx license identifier | spdx license identifier agpl 3 0 or later
mpl-2.0 | tag | spdx license identifier | spdx license identifier mpl 2 0
mpl-1.1 | tag | spdx license identifier | spdx license identifier mpl 1 1
epl-1.0 | tag | spdx license identifier | spdx license identifier epl 1 0
epl-2.0 | tag | spdx license identifier | spdx license identifier epl 2 0
eupl-1.2 | tag | spdx license identifier | spdx license identifier eupl 1 2
bsl-1.0 | tag | spdx license identifier | spdx license identifier bsl 1 0
cc0-1.0 | tag | spdx license identifier | spdx license identifier cc0 1 0
cc-by-4.0 | tag | spdx license identifier | spdx license identifier cc by 4 0
cc-by-sa-4.0 | tag | spdx license identifier | spdx license identifier cc by sa 4 0
cc-by-nc-4.0 | tag | spdx license identifier | spdx license identifier cc by nc 4 0
cc-by-nd-4.0 | tag | spdx license identifier | spdx license identifier cc by nd 4 0
cc-by-nc-sa-4.0 | tag | spdx license identifier | spdx license identifier cc by nc sa 4 0
cc-by-nc-nd-4.0 | tag | spdx license identifier | spdx license identifier cc by nc nd 4 0
artistic-2.0 | tag | spdx license identifier | spdx license identifier artistic 2 0
ofl-1.1 | tag | spdx license identifier | spdx license identifier ofl 1 1
ms-pl | tag | spdx license identifier | spdx license identifier ms pl
cddl-1.0 | tag | spdx license identifier | spdx license identifier cddl 1 0
postgresql | tag | spdx license identifier | spdx license identifier postgresql
other-spdx | tag | spdx license identifier | spdx license identifier [a-z0-9]+(?: [0-9]+){0,2}
mit | text | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
mit | text | the above copyright notice and this | the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the software
mit-or-similar | text | the software is provided as is | the software is provided as is without warranty of any kind
ofl-1.1 | text | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of the font software
bsl-1.0 | text | permission is hereby granted | permission is hereby granted free of charge to any person or organization obtaining a copy of the software
isc | text | permission to use copy modify | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
hpnd | text | permission to use copy modify | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
bsd | text | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted
bsd | text | redistributions of source code must | redistributions of source code must retain the above copyright notice
bsd | text | redistributions in binary form must | redistributions in binary form must reproduce the above copyright notice
bsd-3-clause | text | neither the name | neither the names? of (?:[a-z0-9]+ ){1,12}nor the names? of (?:its|their|the) contributors may be used to endorse or promote products
bsd-4-clause | text | all advertising materials | all advertising materials mentioning features or use of this software must display
zlib | text | this software is provided as is | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | text | altered source versions | altered source versions must be plainly marked as such
apache-2.0 | text | you may not use this file except | you may not use this file except in compliance with the license
apache-2.0 | text | unless required by applicable law | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2.0 | text | you may obtain a copy of the license | you may obtain a copy of the license at(?: https?)? www apache org licenses license 2 0
gpl | text | this program is free software | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
lgpl | text | this library is free software | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
gpl | text | you should have received a copy | you should have received a copy of the gnu general public license along with
lgpl | text | you should have received a copy | you should have received a copy of the gnu (?:lesser|library) general public license along with
agpl | text | you should have received a copy | you should have received a copy of the gnu affero general public license along with
gpl | text | everyone is permitted to copy | everyone is permitted to copy and distribute verbatim copies of this license document
wtfpl | text | you just do what the | you just do what the fuck you want to
wtfpl | text | everyone is permitted to copy | everyone is permitted to copy and distribute verbatim or modified copies of this license document
mpl-2.0 | text | this source code form is subject | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-1.1 | text | the contents of this file are subject | the contents of this file are subject to the mozilla public license version 1 1
cddl-1.0 | text | the contents of this file are subject | the contents of this file are subject to the terms of the common development and distribution license
epl | text | this program and the accompanying | this program and the accompanying materials are made available under the terms of the eclipse public license
unlicense | text | this is free and unencumbered | this is free and unencumbered software released into the public domain
cc0-1.0 | text | to the extent possible under law | to the extent possible under law (?:[a-z0-9]+ ){1,10}waived all copyright and related or neighboring rights
boost | text | the copyright notices in the software | the copyright notices in the software and this entire statement
openssl | text | this product includes software | this product includes software developed by the openssl project
apache-1.1 | text | this product includes software | this product includes software developed by the apache software foundation
bsd-4-clause | text | this product includes software | this product includes software developed by the university of california
python | text | psf hereby grants | psf hereby grants licensee a nonexclusive royalty free world wide license
ncsa | text | permission is hereby granted | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software
json | text | the software shall be used for good | the software shall be used for good not evil
beerware | text | as long as you retain this notice | as long as you retain this notice you can do whatever you want with this stuff
cc-by-4.0 | url | creativecommons org | creativecommons org licenses by 4 0
cc-by-3.0 | url | creativecommons org | creativecommons org licenses by 3 0
cc-by-2.0 | url | creativecommons org | creativecommons org licenses by 2 [05]
cc-by-sa-4.0 | url | creativecommons org | creativecommons org licenses by sa 4 0
cc-by-sa-3.0 | url | creativecommons org | creativecommons org licenses by sa 3 0
cc-by-sa-2.0 | url | creativecommons org | creativecommons org licenses by sa 2 [05]
cc-by-nc-4.0 | url | creativecommons org | creativecommons org licenses by nc 4 0
cc-by-nc-3.0 | url | creativecommons org | creativecommons org licenses by nc 3 0
cc-by-nc-2.0 | url | creativecommons org | creativecommons org licenses by nc 2 [05]
cc-by-nd-4.0 | url | creativecommons org | creativecommons org licenses by nd 4 0
cc-by-nd-3.0 | url | creativecommons org | creativecommons org licenses by nd 3 0
cc-by-nc-sa-4.0 | url | creativecommons org | creativecommons org licenses by nc sa 4 0
cc-by-nc-sa-3.0 | url | creativecommons org | creativecommons org licenses by nc sa 3 0
cc-by-nc-nd-4.0 | url | creativecommons org | creativecommons org licenses by nc nd 4 0
cc-by-nc-nd-3.0 | url | creativecommons org | creativecommons org licenses by nc nd 3 0
cc0-1.0 | url | creativecommons org | creativecommons org publicdomain zero 1 0
public-domain-mark | url | creativecommons org | creativecommons org publicdomain mark 1 0
apache-2.0 | url | apache org licenses | apache org licenses license 2 0
gpl | url | gnu org licenses | gnu org licenses (?:old licenses )?gpl(?: [123] 0)?
lgpl | url | gnu org licenses | gnu org licenses (?:old licenses )?lgpl(?: [23] [01])?
agpl | url | gnu org licenses | gnu org licenses agpl(?: 3 0)?
gfdl | url | gnu org licenses | gnu org licenses fdl(?: 1 [123])?
gfdl | url | gnu org copyleft | gnu org copyleft fdl
mit | url | opensource org licenses | opensource org licenses mit(?: license)?
bsd-2-clause | url | opensource org licenses | opensource org licenses bsd 2 clause
bsd-3-clause | url | opensource org licenses | opensource org licenses bsd 3 clause
isc | url | opensource org licenses | opensource org licenses isc(?: license)?
mpl-2.0 | url | mozilla org mpl | mozilla org mpl 2 0
mpl-1.1 | url | mozilla org mpl | mozilla org mpl(?: mpl)? 1 1
epl-1.0 | url | eclipse org legal | eclipse org legal epl v10
epl-2.0 | url | eclipse org legal | eclipse org legal epl (?:v20|2 0)
bsl-1.0 | url | boost org license | boost org license 1 0
unlicense | url | unlicense org | unlicense org
ofl-1.1 | url | scripts sil org | scripts sil org ofl
odbl-1.0 | url | opendatacommons org | opendatacommons org licenses odbl
odc-by-1.0 | url | opendatacommons org | opendatacommons org licenses by
pddl-1.0 | url | opendatacommons org | opendatacommons org licenses pddl
wtfpl | url | wtfpl net | wtfpl net
mit | grant | mit licen | (?:licensed|released|distributed|available|published|provided|covered)(?: [a-z]+){0,3} (?:under|with|by) (?:the )?(?:terms of the )?mit licen[cs]e
apache-2.0 | grant | apache licen | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?apache licen[cs]e (?:version |v )?2(?: 0)?
apache | grant | apache licen | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?apache licen[cs]e
gpl-2.0 | grant | gnu general public | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v )?2(?: 0)?
gpl-3.0 | grant | gnu general public | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?gnu general public licen[cs]e (?:version |v )?3(?: 0)?
gpl | grant | gnu general public | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?gnu general public licen[cs]e
lgpl | grant | gnu l | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?gnu (?:lesser|library) general public licen[cs]e(?: (?:version |v )?[23](?: [01])?)?
agpl-3.0 | grant | gnu affero | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?gnu affero general public licen[cs]e(?: (?:version |v )?3(?: 0)?)?
gfdl | grant | gnu free doc | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?gnu free documentation licen[cs]e(?: (?:version |v )?1 [123])?
bsd | grant | bsd | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the |a )?(?:terms of the )?(?:new |modified |simplified |revised )?bsd(?: style)? licen[cs]e
bsd-2-clause | grant | bsd | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?(?:(?:2|two) clause bsd|bsd (?:2|two) clause) licen[cs]e
bsd-3-clause | grant | bsd | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?(?:(?:3|three) clause bsd|bsd (?:3|three) clause) licen[cs]e
mpl-2.0 | grant | mozilla public | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?mozilla public licen[cs]e (?:version |v )?2(?: 0)?
mpl | grant | mozilla public | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?mozilla public licen[cs]e
epl | grant | eclipse public | (?:licensed|released|distributed|available|published|provided)(?: [a-z]+){0,3} under (?:the )?(?:terms of the )?eclipse public licen[cs]e(?: (?:version |v )?[12](?: 0)?)?
cc-by-4.0 | grant | cc by | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by (?:4 0|licen[cs]e)
cc-by-sa-4.0 | grant | cc by sa | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by sa 4 0
cc-by-sa-3.0 | grant | cc by sa | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by sa 3 0
cc-by-nc-4.0 | grant | cc by nc | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by nc 4 0
cc-by-nc-3.0 | grant | cc by nc | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by nc 3 0
cc-by-nd-4.0 | grant | cc by nd | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by nd 4 0
cc-by-nc-sa-4.0 | grant | cc by nc sa | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by nc sa 4 0
cc-by-nc-nd-4.0 | grant | cc by nc nd | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?cc by nc nd 4 0
creative-commons | grant | creative commons | (?:licensed|released|distributed|available|published|provided|shared)(?: [a-z]+){0,3} under (?:the |a )?creative commons(?: [a-z]+){0,6} licen[cs]e
public-domain | grant | public domain | (?:released|dedicated|placed|donated)(?: [a-z]+){0,3} (?:in|into|to) the public domain
isc | grant | isc licen | (?:licensed|released|distributed|available|published)(?: [a-z]+){0,3} under (?:the )?isc licen[cs]e
dual | grant | dual licensed | dual licensed under (?:the )?(?:[a-z0-9]+ ){1,6}(?:and|or) (?:the )?(?:[a-z0-9]+ ){0,6}licen[cs]es?
gpl-2.0-or-later | grant | gnu general public | gnu general public licen[cs]e as published by the free software foundation either version 2 of the license or (?:at your option )?any later version
gpl-3.0-or-later | grant | gnu general public | gnu general public licen[cs]e as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
lgpl-2.1-or-later | grant | gnu lesser | gnu lesser general public licen[cs]e as published by the free software foundation either version 2 1 of the license or (?:at your option )?any later version
lgpl-3.0-or-later | grant | gnu lesser | gnu lesser general public licen[cs]e as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
agpl-3.0-or-later | grant | gnu affero | gnu affero general public licen[cs]e as published by the free software foundation either version 3 of the license or (?:at your option )?any later version
mit | name | mit licen | (?:the )?mit licen[cs]e
mit-0 | name | mit no attribution | mit no attribution(?: licen[cs]e)?
mit | name | expat licen | expat licen[cs]e
x11 | name | x11 licen | x11 licen[cs]e
apache-2.0 | name | apache licen | apache (?:software )?licen[cs]e (?:version |v )?2(?: 0)?
apache-2.0 | name | apache 2 | apache 2(?: 0)?(?: licen[cs]e)?
apache-2.0 | name | asl 2 | asl 2 0
apache-1.1 | name | apache software licen | apache software licen[cs]e (?:version )?1 1
apache-1.0 | name | apache software licen | apache software licen[cs]e (?:version )?1 0
apache | name | apache licen | apache licen[cs]e
gpl-1.0 | name | gnu general public | gnu general public licen[cs]e (?:version |v )?1(?: 0)?
gpl-2.0 | name | gnu general public | gnu general public licen[cs]e (?:version |v )?2(?: 0)?
gpl-3.0 | name | gnu general public | gnu general public licen[cs]e (?:version |v )?3(?: 0)?
gpl | name | gnu general public | gnu general public licen[cs]e
gpl | name | gnu gpl | gnu gpl
gpl-2.0 | name | gpl | gpl ?v?2(?: 0)?
gpl-3.0 | name | gpl | gpl ?v?3(?: 0)?
lgpl-2.0 | name | gnu library | gnu library general public licen[cs]e(?: (?:version |v )?2(?: 0)?)?
lgpl-2.1 | name | gnu lesser | gnu lesser general public licen[cs]e (?:version |v )?2 1
lgpl-3.0 | name | gnu lesser | gnu lesser general public licen[cs]e (?:version |v )?3(?: 0)?
lgpl | name | gnu lesser | gnu lesser general public licen[cs]e
lgpl-2.1 | name | lgpl | lgpl ?v?2 ?1
lgpl-3.0 | name | lgpl | lgpl ?v?3(?: 0)?
lgpl | name | lgpl | lgpl
agpl-3.0 | name | gnu affero | gnu affero general public licen[cs]e(?: (?:version |v )?3(?: 0)?)?
agpl-3.0 | name | agpl | agpl(?: ?v?3)?(?: 0)?
gfdl | name | gnu free doc | gnu free documentation licen[cs]e(?: (?:version |v )?1 [123])?
gfdl | name | gfdl | gfdl(?: 1 [123])?
bsd-2-clause | name | simplified bsd | simplified bsd licen[cs]e
bsd-2-clause | name | freebsd licen | freebsd licen[cs]e
bsd-2-clause | name | bsd 2 | bsd 2 clause(?: licen[cs]e)?
bsd-2-clause | name | 2 clause bsd | 2 clause bsd(?: licen[cs]e)?
bsd-3-clause | name | new bsd | new bsd licen[cs]e
bsd-3-clause | name | modified bsd | modified bsd licen[cs]e
bsd-3-clause | name | revised bsd | revised bsd licen[cs]e
bsd-3-clause | name | bsd 3 | bsd 3 clause(?: licen[cs]e)?
bsd-3-clause | name | 3 clause bsd | 3 clause bsd(?: licen[cs]e)?
bsd-4-clause | name | bsd 4 | bsd 4 clause(?: licen[cs]e)?
bsd-4-clause | name | original bsd | original bsd licen[cs]e
0bsd | name | zero clause bsd | zero clause bsd(?: licen[cs]e)?
bsd | name | bsd licen | bsd licen[cs]e
bsd | name | bsd style | bsd style licen[cs]e
isc | name | isc licen | isc licen[cs]e
zlib | name | zlib licen | zlib licen[cs]e
libpng | name | libpng licen | libpng licen[cs]e
mpl-2.0 | name | mozilla public | mozilla public licen[cs]e (?:version |v )?2(?: 0)?
mpl-1.1 | name | mozilla public | mozilla public licen[cs]e (?:version |v )?1 1
mpl-1.0 | name | mozilla public | mozilla public licen[cs]e (?:version |v )?1 0
mpl | name | mozilla public | mozilla public licen[cs]e
epl-1.0 | name | eclipse public | eclipse public licen[cs]e (?:version |v )?1 0
epl-2.0 | name | eclipse public | eclipse public licen[cs]e (?:version |v )?2 0
epl | name | eclipse public | eclipse public licen[cs]e
edl-1.0 | name | eclipse distribution | eclipse distribution licen[cs]e(?: v? ?1 0)?
cddl-1.0 | name | common development | common development and distribution licen[cs]e(?: (?:version |v )?1 [01])?
cpl-1.0 | name | common public | common public licen[cs]e(?: (?:version |v )?1 0)?
cpal-1.0 | name | common public attribution | common public attribution licen[cs]e(?: (?:version |v )?1 0)?
ipl-1.0 | name | ibm public | ibm public licen[cs]e
eupl | name | european union public | european union public licen[cs]e(?: (?:version |v )?1 [12])?
cecill | name | cecill | cecill(?: [bc])?(?: free software licen[cs]e)?
bsl-1.0 | name | boost software | boost software licen[cs]e(?: (?:version )?1 0)?
artistic-1.0 | name | artistic licen | artistic licen[cs]e 1 0
artistic-2.0 | name | artistic licen | artistic licen[cs]e 2 0
artistic | name | artistic licen | artistic licen[cs]e
afl-3.0 | name | academic free | academic free licen[cs]e(?: (?:version |v )?[123] [01])?
osl-3.0 | name | open software licen | open software licen[cs]e(?: (?:version |v )?[123] [01])?
ms-pl | name | microsoft public | microsoft public licen[cs]e
ms-rl | name | microsoft reciprocal | microsoft reciprocal licen[cs]e
apsl | name | apple public source | apple public source licen[cs]e
postgresql | name | postgresql licen | postgresql licen[cs]e
python | name | python software foundation | python software foundation licen[cs]e(?: version 2)?
php | name | php licen | php licen[cs]e(?: (?:version )?3 0[01]?)?
ruby | name | ruby licen | ruby licen[cs]e
openssl | name | openssl licen | openssl licen[cs]e
vim | name | vim licen | vim licen[cs]e
wtfpl | name | wtfpl | wtfpl
unlicense | name | unlicense | (?:the )?unlicense
beerware | name | beer ware | beer ware licen[cs]e
ncsa | name | university of illinois | university of illinois ncsa open source licen[cs]e
upl-1.0 | name | universal permissive | universal permissive licen[cs]e(?: v? ?1 0)?
qpl-1.0 | name | q public licen | q public licen[cs]e
sissl | name | sun industry | sun industry standards source licen[cs]e
w3c | name | w3c software | w3c software (?:notice and )?licen[cs]e
ofl-1.1 | name | sil open font | sil open font licen[cs]e(?: (?:version )?1 1)?
odbl-1.0 | name | open database licen | open database licen[cs]e(?: v? ?1 0)?
odc-by-1.0 | name | open data commons | open data commons attribution licen[cs]e
pddl-1.0 | name | open data commons | open data commons public domain dedication and licen[cs]e
ogl-3.0 | name | open government licen | open government licen[cs]e(?: (?:version |v )?[123](?: 0)?)?
etalab | name | licence ouverte | licence ouverte(?: (?:version )?[12] 0)?
busl-1.1 | name | business source | business source licen[cs]e(?: 1 1)?
sspl-1.0 | name | server side public | server side public licen[cs]e
elastic-2.0 | name | elastic licen | elastic licen[cs]e(?: 2 0)?
commons-clause | name | commons clause | commons clause(?: licen[cs]e condition)?
polyform | name | polyform | polyform (?:noncommercial|small business|shield|strict|perimeter)(?: licen[cs]e)?
openrail | name | openrail | openrail(?: m)?(?: licen[cs]e)?
openrail | name | open rail | open rail(?: m)? licen[cs]e
cc0-1.0 | name | cc0 | cc0(?: 1 0)?(?: universal)?
cc-by-4.0 | name | cc by | cc by 4 0
cc-by-3.0 | name | cc by | cc by 3 0
cc-by-2.0 | name | cc by | cc by 2 [05]
cc-by-sa-4.0 | name | cc by sa | cc by sa 4 0
cc-by-sa-3.0 | name | cc by sa | cc by sa 3 0
cc-by-sa-2.0 | name | cc by sa | cc by sa 2 [05]
cc-by-sa | name | cc by sa | cc by sa
cc-by-nc-4.0 | name | cc by nc | cc by nc 4 0
cc-by-nc-3.0 | name | cc by nc | cc by nc 3 0
cc-by-nc-2.0 | name | cc by nc | cc by nc 2 [05]
cc-by-nd-4.0 | name | cc by nd | cc by nd 4 0
cc-by-nd | name | cc by nd | cc by nd
cc-by-nc-sa-4.0 | name | cc by nc sa | cc by nc sa 4 0
cc-by-nc-sa-3.0 | name | cc by nc sa | cc by nc sa 3 0
cc-by-nc-sa | name | cc by nc sa | cc by nc sa
cc-by-nc-nd-4.0 | name | cc by nc nd | cc by nc nd 4 0
cc-by-nc-nd-3.0 | name | cc by nc nd | cc by nc nd 3 0
cc-by-nc-nd | name | cc by nc nd | cc by nc nd
cc-by-4.0 | name | creative commons | creative commons attribution 4 0(?: international)?
cc-by-3.0 | name | creative commons | creative commons attribution 3 0(?: unported)?
cc-by-sa-4.0 | name | creative commons | creative commons attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0 | name | creative commons | creative commons attribution share ?alike 3 0(?: unported)?
cc-by-nc-4.0 | name | creative commons | creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nd-4.0 | name | creative commons | creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-nc-sa-4.0 | name | creative commons | creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-nd-4.0 | name | creative commons | creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?
creative-commons | name | creative commons | creative commons(?: licen[cs]e)?
gpl | hint | gpl | gpl
public-domain | hint | public domain | public domain
proprietary | hint | all rights reserved | all rights reserved
proprietary | hint | proprietary and confidential | proprietary and confidential
proprietary | hint | unauthorized copying | unauthorized copying of this file
proprietary | hint | no part of this | no part of this (?:publication|book|work|document) may be reproduced
non-commercial | hint | non commercial use | (?:for )?non commercial use only
non-commercial | hint | not for commercial | not for commercial use
research-only | hint | for research | for research (?:purposes|use) only
evaluation-only | hint | for evaluation | for evaluation (?:purposes|use) only
no-warranty | hint | without warranty of any | without warranty of any kind
copyleft | hint | copyleft | copyleft
open-source | hint | open source licen | open source licen[cs]e
unspecified | hint | licensed under | licensed under
unspecified | hint | under licen | under licen[cs]e
unspecified | hint | end user licen | end user licen[cs]e agreement
"""


class Rule(NamedTuple):
    order: int
    label: str
    kind: str
    priority: int
    confidence: float
    keyword: str
    pattern: str
    base: bool


def rules() -> list[Rule]:
    """Base phrases first, then the signatures, numbered in order."""
    lines = [(line, base) for block, base in ((BASE, True), (RULES, False)) for line in block.strip().splitlines()]
    out = []
    for order, (line, base) in enumerate(lines):
        label, kind, keyword, pattern = (part.strip() for part in line.split(" | ", 3))
        out.append(Rule(order, label, kind, *KINDS[kind], keyword, pattern, base))
    return out
