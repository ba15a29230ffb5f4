"""Rules of operator 5 for the wording of licenses: clauses, grants, notices and file headers.

Each line is ``label | keyword | expression`` over folded words (small letters and digits,
parted by single spaces); the keyword is a part of every text that the expression matches.
"""

CLAUSES = r"""
apache-2.0 | you may not use this file except in compliance | you may not use this file except in compliance with the license
apache-2.0 | obtain a copy of the license at | you may obtain a copy of the license at http www apache org licenses
apache-2.0 | distributed on an as is basis | software distributed under the license is distributed on an as is basis
apache-2.0 | without warranties or conditions of any kind | without warranties or conditions of any kind either express or implied
apache-2.0 | terms and conditions for use reproduction and distribution | terms and conditions for use reproduction and distribution 1 definitions
apache-2.0 | each contributor hereby grants to you a perpetual | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|except as stated)
apache-2.0 | licensed to the apache software foundation | licensed to the apache software foundation asf under one or more contributor license agreements
apache-2.0 | asf licenses this file to you | the asf licenses this file to you under the apache license
apache-2.0 | asl 2 0 | (?:the )?asl 2 0
apache-1.1 | this product includes software developed by the apache | this product includes software developed by the apache (?:software foundation|group)
apache-1.1 | products derived from this software may not be called apache | products derived from this software may not be called apache nor may apache appear in their name
mit | without restriction including without limitation the rights | to deal in the software without restriction including without limitation the rights to use copy modify merge publish
mit | shall be included in all copies or substantial portions | (?:the above copyright notice and )?this permission notice shall be included in all copies or substantial portions of the software
mit | noninfringement in no event shall the authors | fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable
mit | mit style | mit style licen[cs]e
mit | license mit | license mit
mit | mit x11 | mit x11(?: license)?
mit | licenses mit license | licenses mit license (?:php|txt|html)
mit-0 | mit 0 | mit 0 license
x11 | name of the x consortium shall not be used | the name of the x consortium shall not be used in advertising
x11 | except as contained in this notice | except as contained in this notice the name(?:s)? of (?:\S+ ){1,12}?shall not be used in advertising
isc | permission to use copy modify and distribute this software | permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted
isc | the software is provided as is and the author disclaims | the software is provided as is and the author disclaims all warranties with regard to this software
hpnd | permission to use copy modify and distribute this software and its documentation | permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
ntp | permission to use copy modify and distribute this software and its documentation for any purpose with or without fee | permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted
0bsd | permission to use copy modify and or distribute this software for any | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is
bsd | redistributions of source code must retain | redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd | redistributions in binary form must reproduce | redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer
bsd | this software is provided by the copyright holders and contributors | this software is provided by the copyright holders and contributors as is and any express or implied warranties
bsd | this software is provided by the regents and contributors | this software is provided by the regents and contributors as is
bsd | use of this source code is governed by a bsd | use of this source code is governed by a bsd style license
bsd-3-clause | may be used to endorse or promote products | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause | revised bsd | revised bsd licen[cs]e
bsd-3-clause | bsd 3 | bsd 3(?: license)?
bsd-3-clause | university of california berkeley | regents of the university of california berkeley
bsd-4-clause | this product includes software developed by the university | this product includes software developed by the university of california
bsd-2-clause | bsd 2 | bsd 2(?: license)?
bsd-1-clause | bsd 1 clause | bsd 1 clause(?: license)?
bsd-3-clause-clear | clear bsd | (?:the )?clear bsd license
bsd-3-clause-clear | no express or implied licenses to any party s patent | no express or implied licenses to any party s patent rights are granted by this license
bsd-2-clause-patent | bsd plus patent | bsd (?:2 clause )?plus patent license
bsd-protection | bsd protection license | bsd protection license
gpl | this program is free software you can redistribute it | this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl | you should have received a copy of the gnu general public license | you should have received a copy of the gnu general public license along with this program
gpl | either version | either version [123](?: 0)? of the license or at your option any later version
gpl | gpl compatible | gpl compatible
gpl | gpl licensed | gpl licensed
gpl | gnu copyleft | gnu copyleft
gpl-2.0 | gpl v2 | (?:gnu )?gpl v2(?: 0)?
gpl-3.0 | gpl v3 | (?:gnu )?gpl v3(?: 0)?
gpl-2.0 | gpl version 2 | (?:gnu )?gpl version 2
gpl-3.0 | gpl version 3 | (?:gnu )?gpl version 3
gpl-2.0-only | gpl 2 0 only | gpl 2 0 only
gpl-3.0-only | gpl 3 0 only | gpl 3 0 only
gpl-2.0-or-later | gpl 2 0 or later | gpl 2 0 or later
gpl-3.0-or-later | gpl 3 0 or later | gpl 3 0 or later
gpl-2.0 | the licenses for most software are designed to take away | the licenses for most software are designed to take away your freedom
gpl-3.0 | the licenses for most software and other practical works | the licenses for most software and other practical works are designed to take away your freedom
gpl-1.0 | the license agreements of most software companies | the license agreements of most software companies (?:try to )?keep users at the mercy
gpl-2.0 | 51 franklin st | free software foundation inc 51 franklin st(?:reet)? fifth floor boston
gpl-2.0 | 59 temple place | free software foundation inc 59 temple place(?: suite 330)? boston
gpl-classpath | classpath exception | (?:with (?:the )?)?classpath exception
gpl-classpath | linking this library statically or dynamically | linking this library statically or dynamically with other modules is making a combined work
gcc-exception | gcc runtime library exception | gcc runtime library exception(?: version 3 1)?
autoconf-exception | autoconf configure script exception | autoconf configure script exception
bison-exception | bison exception | (?:special )?bison exception
font-exception | font exception | (?:gpl )?font exception
linux-syscall-note | linux syscall note | linux syscall note
lgpl | this library is free software you can redistribute it | this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl | you should have received a copy of the gnu lesser general public license | you should have received a copy of the gnu lesser general public license along with this (?:library|program)
lgpl-3.0 | lgpl v3 | (?:gnu )?lgpl v3(?: 0)?
lgpl-2.1 | lgpl v2 1 | (?:gnu )?lgpl v2 1
lgpl-2.1 | lgpl version 2 1 | (?:gnu )?lgpl version 2 1
lgpl-3.0 | lgpl version 3 | (?:gnu )?lgpl version 3
lgpl-2.1-or-later | lgpl 2 1 or later | lgpl 2 1 or later
lgpl-3.0-or-later | lgpl 3 0 or later | lgpl 3 0 or later
agpl | you should have received a copy of the gnu affero | you should have received a copy of the gnu affero general public license along with this program
agpl-3.0 | remote network interaction | remote network interaction use with the gnu general public license
agpl-3.0 | agpl v3 | (?:gnu )?agpl v3(?: 0)?
agpl-3.0 | agpl version 3 | (?:gnu )?agpl version 3
agpl-3.0-or-later | agpl 3 0 or later | agpl 3 0 or later
agpl-3.0-only | agpl 3 0 only | agpl 3 0 only
gfdl | permission is granted to copy distribute and or modify this document | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl | with no invariant sections | with no invariant sections no front cover texts and no back cover texts
gfdl | gfdl | (?:gnu )?gfdl(?: 1 [123])?
mpl-2.0 | this source code form is subject to the terms | this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2.0 | if a copy of the mpl was not distributed | if a copy of the mpl was not distributed with this file you can obtain one at
mpl-2.0 | incompatible with secondary licenses | this source code form is incompatible with secondary licenses
mpl-1.1 | the contents of this file are subject to the mozilla public license | the contents of this file are subject to the mozilla public license version 1 1
mpl-2.0 | mpl 2 0 | mpl 2 0
mpl-1.1 | mpl 1 1 | mpl 1 1
npl-1.1 | netscape public license | netscape public license(?: version)?(?: 1 [01])?
epl-1.0 | the accompanying program is provided under the terms of this eclipse | the accompanying program is provided under the terms of this eclipse public license
epl-1.0 | this program and the accompanying materials are made available | this program and the accompanying materials are made available under the terms of the eclipse public license v1 0
epl-2.0 | this program and the accompanying materials are made available under the terms of the eclipse public license | this program and the accompanying materials are made available under the terms of the eclipse public license 2 0
cpl-1.0 | made available under the terms of the common public license | made available under the terms of the common public license
cddl | the contents of this file are subject to the terms of the common development | the contents of this file are subject to the terms of the common development and distribution license
cddl | cddl licensed | cddl licensed
apsl-2.0 | apple public source license | apple public source license(?: version)?(?: 2 0)?
apsl-2.0 | file contains original code and or modifications of original code | (?:this )?file contains original code and or modifications of original code as defined in
artistic-1.0 | intent of this document is to state the conditions under which a package may be copied | the intent of this document is to state the conditions under which a package may be copied
artistic-2.0 | this license establishes the terms under which a given free software package | this license establishes the terms under which a given free software package may be copied
clartistic | clarified artistic license | clarified artistic license
python-2.0 | psf is making python available | psf is making python available to licensee on an as is basis
python-2.0 | beopen python open source license | beopen python open source license agreement
cnri-python | cnri open source license agreement | cnri open source license agreement
boost-1.0 | permission is hereby granted free of charge to any person or organization | permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation
boost-1.0 | distributed under the boost software license | distributed under the boost software license
boost-1.0 | boost org license 1 0 | boost org license 1 0(?: txt)?
zlib | the origin of this software must not be misrepresented | the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib | altered source versions must be plainly marked | altered source versions must be plainly marked as such and must not be misrepresented
unlicense | anyone is free to copy modify publish use compile sell | anyone is free to copy modify publish use compile sell or distribute this software
unlicense | unlicense org | (?:refer to |see )?(?:https? )?(?:www )?unlicense org
wtfpl | everyone is permitted to copy and distribute verbatim or modified copies | everyone is permitted to copy and distribute verbatim or modified copies of this license document
beerware | you can buy me a beer | you can buy me a beer in return
ms-pl | ms pl | ms pl
ms-rl | ms rl | ms rl
ms-lpl | microsoft limited public license | microsoft limited public license
ms-eula | microsoft software license terms | microsoft software license terms
eupl-1.2 | licensed under the eupl | licensed under the eupl (?:version )?(?:v )?1 2
eupl | licensed under the eupl | licensed under the eupl
osl-3.0 | osl 3 0 | osl 3 0
afl-3.0 | afl 3 0 | afl 3 0
afl-2.1 | academic free license | academic free license (?:version |v )?2 1
ofl-1.1 | scripts sil org ofl | scripts sil org ofl
ofl-1.1 | this font software is licensed under the sil | this font software is licensed under the sil open font license
ofl-1.1 | reserved font name | with reserved font name
ubuntu-font-1.0 | ubuntu font licen | ubuntu font licen[cs]e(?: version)?(?: 1 0)?
bitstream-vera | bitstream vera | bitstream vera(?: fonts)? (?:copyright|license)
lppl | this work may be distributed and or modified under the conditions of the latex | this work may be distributed and or modified under the conditions of the latex project public license
odbl-1.0 | made available under the open database license | made available under the open database license
odbl-1.0 | opendatacommons org licenses odbl | opendatacommons org licenses odbl(?: 1 0)?
odc-by-1.0 | opendatacommons org licenses by | opendatacommons org licenses by(?: 1 0)?
pddl-1.0 | opendatacommons org licenses pddl | opendatacommons org licenses pddl(?: 1 0)?
dbcl-1.0 | database contents license | database contents license(?: v?1 0)?
cdla-permissive-2.0 | community data license agreement permissive | community data license agreement permissive(?: version)?(?: 2 0)?
cdla-sharing-1.0 | community data license agreement sharing | community data license agreement sharing(?: version)?(?: 1 0)?
ogl-2.0 | open government licen | open government licen[cs]e v?2 0
ogl-1.0 | open government licen | open government licen[cs]e v?1 0
ogl-canada | open government licence canada | open government licence canada
etalab-2.0 | licence ouverte | licence ouverte(?: open licence)?(?: version)?(?: 2 0)?
dl-de-by-2.0 | datenlizenz deutschland | datenlizenz deutschland (?:namensnennung|zero)(?: version)?(?: 2 0)?
gpl | gnu allgemeine offentliche lizenz | gnu allgemeine offentliche lizenz
cc-by-sa | dual licensed under the gfdl and creative commons | dual licensed under the gfdl and creative commons
cc-by | this work is licensed under a creative commons attribution | this work is licensed under a creative commons attribution(?: \d 0)? (?:international |unported |generic )?license
cc-by-nc | creative commons noncommercial | creative commons noncommercial
cc-sampling | creative commons sampling plus | creative commons sampling plus
cc | some rights reserved | some rights reserved
cc | creative commons license | (?:under a |under the )?creative commons licen[cs]e
cc0-1.0 | has waived all copyright and related | has waived all copyright and related or neighboring rights
cc0-1.0 | no rights reserved | no rights reserved
pdm-1.0 | free of known copyright restrictions | (?:this work (?:has been identified as|is) )?(?:being )?free of known copyright restrictions
public-domain | no copyright is claimed | no copyright is claimed
public-domain | not subject to copyright protection | not subject to copyright protection(?: in the united states)?
public-domain | work of the united states government | (?:is )?a work of the united states government
public-domain | author disclaims copyright to this source code | the author disclaims copyright to this source code
public-domain | dedicate any and all copyright interest | dedicate any and all copyright interest in the software to the public domain
postgresql | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement | permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement
openssl | this product includes software developed by the openssl project | this product includes software developed by the openssl project
ssleay | this product includes cryptographic software written by eric young | this product includes cryptographic software written by eric young
openldap | openldap public license | (?:the )?openldap public license version 2 8
sleepycat | redistributions in any form must be accompanied by information on how to obtain | redistributions in any form must be accompanied by information on how to obtain complete source code
w3c | w3c document license | w3c document license
ncsa | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files to deal with | to deal with the software without restriction
unicode | unicode inc license agreement | unicode inc license agreement data files and software
unicode | permission is hereby granted free of charge to any person obtaining a copy of the unicode data files | obtaining a copy of the unicode data files
curl | copyright c 1996 | copyright c 1996 (?:20\d\d )?daniel stenberg
info-zip | info zip license | info zip license
imagemagick | imagemagick license | imagemagick license
ijg | independent jpeg group | this software is based in part on the work of the independent jpeg group
libtiff | names of sam leffler and silicon graphics | the names of sam leffler and silicon graphics may not be used
tcl-tk | regents of the university of california sun microsystems | regents of the university of california sun microsystems inc scriptics corporation
bzip2 | bzip2 license | bzip2(?: and libbzip2)? license
freetype | freetype project license | (?:the )?freetype project license
ftl | freetype license | freetype license
xfree86 | xfree86 license | xfree86 license
erlpl-1.1 | erlang public license | erlang public license(?: version)?(?: 1 1)?
sgi-b-2.0 | sgi free software license b | sgi free software license b(?: version)?(?: 2 0)?
sissl | sun industry standards source license | sun industry standards source license
spl-1.0 | sun public license | sun public license(?: version)?(?: 1 0)?
nasa-1.3 | nasa open source agreement | nasa open source agreement(?: version)?(?: 1 3)?
naist-2003 | naist | naist(?: 2003)? license
watcom-1.0 | sybase open watcom public license | sybase open watcom public license
ruby | you can redistribute it and or modify it under either the terms of the gpl | you can redistribute it and or modify it under either the terms of the gpl
vim | vim is charityware | vim is charityware
sspl-1.0 | sspl | sspl(?: v1| 1 0)?
bsl-1.1 | additional use grant | additional use grant
bsl-1.1 | change license | change date (?:\S+ ){1,6}?change license
confluent-community | confluent community license | confluent community license(?: agreement)?
elastic-2.0 | elv2 | elv2
commons-clause | does not include and the license does not grant to you the right to sell | the license does not include and the license does not grant to you the right to sell the software
hippocratic | hippocratic license | hippocratic license(?: version)?(?: \d \d)?
openrail | responsible ai license | (?:open )?responsible ai license
openrail | openrail m | (?:creativeml |bigscience )?openrail m
llama-community | llama 2 community license | llama 2 community license(?: agreement)?
llama-community | llama 3 community license | llama 3 community license(?: agreement)?
bloom-rail | bigscience rail | bigscience rail license
anti-996 | anti 996 license | anti 996 license
proprietary | this document contains proprietary information | this document contains proprietary information
proprietary | confidential and proprietary | (?:strictly )?confidential and proprietary
proprietary | trade secret | (?:contains|constitutes|is a) trade secrets? (?:of|and)
proprietary | may not be reproduced or distributed without | may not be reproduced or distributed without (?:the )?(?:prior )?(?:written )?(?:permission|consent)
proprietary | reproduction in whole or in part | reproduction in whole or in part (?:without (?:written )?permission )?is (?:strictly )?prohibited
proprietary | licensed not sold | (?:the |this )?software is licensed not sold
proprietary | reverse engineer decompile or disassemble | (?:you may not )?reverse engineer decompile or disassemble
proprietary | by installing or using | by installing or using (?:the|this) software you (?:agree|accept)
proprietary | by clicking | by clicking (?:i )?(?:accept|agree) you
proprietary | terms of service | (?:subject to|under) (?:the|our) terms of service
trial | evaluation purposes only | (?:for )?evaluation purposes only
trial | trial version | (?:this is a )?trial version of
shareware | shareware | (?:this (?:program|software) is )?shareware
freeware | freeware | (?:this (?:program|software) is )?freeware
donationware | donationware | donationware
research-only | research purposes only | (?:for )?(?:academic )?research purposes only
non-commercial | not for commercial use | not for commercial use
non-commercial | personal use only | (?:for )?personal use only
non-commercial | personal and non commercial use | (?:for )?(?:your )?personal and non commercial use
no-derivatives | no derivative works | no derivative works (?:are )?(?:allowed|permitted)
no-ai | may not be used to train | may not be used to train (?:\S+ ){0,4}?(?:models?|ai|systems?)
dual | dual licensed under | (?:this (?:software|project) is )?dual licensed under
dual | at your option any of the following licenses | at your option any of the following licenses
permission | reprinted with permission | reprinted with permission(?: of)?
permission | reproduced with permission | reproduced with permission(?: of)?
permission | used by permission | used by permission
copyleft | copyleft | (?:strong |weak )?copyleft
patent-grant | additional grant of patent rights | additional grant of patent rights(?: version 2)?
cla | contributor license agreement | (?:individual |corporate )?contributor license agreement
dco | developer certificate of origin | developer certificate of origin(?: version)?(?: 1 1)?
warranty | there is no warranty for the program | there is no warranty for the program to the extent permitted by applicable law
warranty | without any warranty without even the implied warranty | without any warranty without even the implied warranty of merchantability
warranty | in no event shall | in no event shall (?:\S+ ){1,12}?be liable for any (?:direct|claim|damages|special)
all-rights | tous droits reserves | tous droits reserves
all-rights | alle rechte vorbehalten | alle rechte vorbehalten
all-rights | todos los derechos reservados | todos los derechos reservados
"""
