"""Signatures of licence texts and notices: what stands in them rather than what they are called.

Each is (label, keyword, expression) over words of a-z and 0-9 with single spaces. The keyword is part of whatever
the expression fits. Of texts that share words the more particular comes first.
"""

from __future__ import annotations

_ANY = r"( \w+){0,12}"

TEXTS = [
    # Permission by a short grant.
    ("mit-0", "any person obtaining a copy", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("bsl-1.0", "any person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("bsl-1.0", "boost software", r"distributed under the boost software license version 1 0"),
    ("bsl-1.0", "boost org license", r"(https? )?(www )?boost org license 1 0 txt"),
    ("mit", "any person obtaining a copy", r"permission is hereby granted free of charge to any person obtaining a copy( of this software)?( and associated documentation files)?"),
    ("mit", "deal in the software", r"to deal in the software without restriction including without limitation the rights"),
    ("mit", "this permission notice shall", r"the above copyright notice and this permission notice shall be included in all copies( or substantial portions of the software)?"),
    ("mit", "this permission notice including", r"the above copyright notice and this permission notice including the next paragraph shall be included in all copies"),
    ("mit", "authors or copyright holders", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("x11", "x consortium", r"except as contained in this notice the name of the x consortium shall not be used in advertising"),
    ("mit", "opensource org licenses mit", r"(https? )?(www )?opensource org licenses mit( license)?( php| html)?"),
    ("isc", "modify and or distribute this software", r"permission to use copy modify and or distribute this software for any purpose( with or without fee is hereby granted)?"),
    ("isc", "modify and distribute this software", r"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "author disclaims all warranties", r"the author disclaims all warranties with regard to this software"),
    ("hpnd", "software and its documentation", r"permission to use copy modify (and )?(distribute )?(and )?(sell )?this software and its documentation for any purpose( and)?( with or)?( without fee)?( is hereby granted)?"),
    ("hpnd", "not be used in advertising", r"not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission"),
    ("ntp", "makes no representations about the suitability", r"makes no representations about the suitability (of )?this software for any purpose"),
    # Redistribution in source and binary form.
    ("bsd-4-clause", "all advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clause", "names of its contributors", r"neither the name of" + _ANY + r" nor the names of its contributors may be used to endorse or promote products derived from this software( without specific prior written permission)?"),
    ("bsd-3-clause", "endorse or promote products", r"may (not )?be used to endorse or promote products derived from this software without (specific )?prior written permission"),
    ("bsd", "source and binary forms", r"redistribution and use in source and binary forms with or without modification are permitted( provided that the following conditions are met)?"),
    ("bsd", "redistributions of source code", r"redistributions of source code must retain the above copyright notice( this list of conditions and the following disclaimer)?"),
    ("bsd", "redistributions in binary form", r"redistributions in binary form must reproduce the above copyright notice( this list of conditions and the following disclaimer)?"),
    ("bsd", "copyright holders and contributors", r"this software is provided by the copyright holders and contributors as is"),
    ("bsd", "regents and contributors", r"this software is provided by the regents and contributors as is"),
    ("bsd", "views and conclusions contained", r"the views and conclusions contained in the software and documentation are those of the authors"),
    ("bsd", "opensource org licenses bsd", r"(https? )?(www )?opensource org licenses bsd( \d clause| license)?( php| html)?"),
    ("sleepycat", "db software", r"redistributions in any form must be accompanied by information on how to obtain complete source code for the db software"),
    # Apache.
    ("apache-2.0", "apache org licenses license 2 0", r"(you may obtain a copy of the license at )?(https? )?(www )?apache org licenses license 2 0( txt| html)?"),
    ("apache-2.0", "licensed under the apache", r"licensed under the apache license version 2 0 the license"),
    ("apache-2.0", "perpetual worldwide", r"hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (copyright|patent)"),
    ("apache-2.0", "notice text file", r"if the work includes a notice text file as part of its distribution"),
    ("apache-1.1", "developed by the apache", r"this product includes software developed by the apache (software foundation|group)"),
    ("apache", "contributor license agreements", r"licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache", "except in compliance", r"you may not use this (file|work) except in compliance with the license"),
    ("apache", "distributed on an as is basis", r"software distributed under the license is distributed on an as is basis( without warranties or conditions of any kind)?"),
    # GNU licences and their exceptions.
    ("agpl-3.0", "gnu affero general public license as published", r"terms of the gnu affero general public license as published by the free software foundation( either)? version 3"),
    ("agpl", "remotely through a computer network", r"all users interacting with it remotely through a computer network"),
    ("agpl", "remote network interaction", r"remote network interaction use with the gnu general public license"),
    ("agpl", "copy of the gnu affero", r"you should have received a copy of the gnu affero general public license"),
    ("lgpl-2.1", "first released version of the lesser", r"this is the first released version of the lesser gpl"),
    ("lgpl-3.0", "version of the gnu lesser", r"this version of the gnu lesser general public license incorporates the terms and conditions of version 3"),
    ("lgpl", "this library is free software", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (lesser|library) general public license( as published by the free software foundation)?"),
    ("lgpl", "copy of the gnu lesser", r"you should have received a copy of the gnu lesser general public license"),
    ("lgpl", "copy of the gnu library", r"you should have received a copy of the gnu library general public license"),
    ("gpl-3.0", "either version 3 of the license", r"terms of the gnu general public license as published by the free software foundation either version 3 of the license( or at your option any later version)?"),
    ("gpl-2.0", "either version 2 of the license", r"terms of the gnu general public license as published by the free software foundation either version 2 of the license( or at your option any later version)?"),
    ("gpl-2.0", "foundation version 2", r"terms of the gnu general public license( as published by the free software foundation| by the free software foundation) version 2"),
    ("gpl-3.0", "free copyleft license", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-2.0", "licenses for most software", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", "published by the free software foundation", r"terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this program is free software", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "copy of the gnu general", r"you should have received a copy of the gnu general public license"),
    ("gpl", "hope that it will be useful", r"(is )?distributed in the hope that it will be useful but without any warranty( without even the implied warranty of merchantability or fitness for a particular purpose)?"),
    ("gpl", "copies of this license document", r"everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed"),
    ("gpl", "gnu org licenses", r"see (https? )?(www )?gnu org licenses"),
    ("gpl-classpath-exception", "statically or dynamically with other modules", r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gpl-gcc-exception", "gcc runtime library exception", r"additional permissions described in the gcc runtime library exception"),
    ("gpl-bison-exception", "bison parser skeleton", r"you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-autoconf-exception", "configuration script generated by autoconf", r"distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("gpl-openssl-exception", "program with the openssl", r"permission to link the code of (portions of )?this program with the openssl (library|project)"),
    ("gpl-font-exception", "document which uses this font", r"as a special exception if you create a document which uses this font"),
    ("gfdl", "modify this document", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "invariant sections", r"with no invariant sections( no front cover texts and no back cover texts)?"),
    # Licences by file.
    ("mpl-2.0", "mpl was not distributed", r"if a copy of the mpl was not distributed with this file you can obtain one at( https? (www )?mozilla org mpl 2 0)?"),
    ("mpl-2.0", "source code form is subject", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "secondary licenses", r"this source code form is incompatible with secondary licenses"),
    ("mpl-1.1", "subject to the mozilla", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("npl", "netscape public", r"(the contents of this file are subject to the )?netscape public license"),
    ("epl-2.0", "eclipse org legal epl 2 0", r"(https? )?(www )?eclipse org legal epl 2 0"),
    ("epl-1.0", "eclipse org legal epl v10", r"(https? )?(www )?eclipse org legal epl v10( html)?"),
    ("epl", "accompanying materials are made available", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "eclipse public license agreement", r"the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("cpl", "common public license agreement", r"the accompanying program is provided under the terms of this common public license agreement"),
    ("ibm-pl", "ibm public", r"(the accompanying program is provided under the terms of this )?ibm public license"),
    ("cddl", "cddl header start", r"cddl header start"),
    ("cddl", "common development and distribution license", r"the contents of this file are subject to the terms of (either )?the common development and distribution license"),
    ("eupl", "licensed under the eupl", r"licensed under the eupl( version 1 [12])?"),
    ("osl", "licensed under the open software", r"licensed under the open software license version \d( \d)?"),
    ("artistic", "conditions under which a package", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("perl", "same terms as perl", r"(this (program|library|module) is free software you can redistribute it and or modify it )?under the same terms as perl( itself)?"),
    ("lppl", "latex project public", r"(may be distributed and or modified under the conditions of the )?latex project public licen[cs]e"),
    ("qpl", "q public license", r"(the )?q public license( version 1 0)?"),
    ("zpl", "zope public", r"zope public licen[cs]e( zpl)?( version 2 [01])?"),
    ("apsl", "apple public source", r"apple public source licen[cs]e( version \d \d)?"),
    ("spl", "sun public", r"sun public licen[cs]e"),
    ("rpl", "reciprocal public", r"reciprocal public licen[cs]e"),
    ("ms-pl", "microsoft public", r"microsoft public licen[cs]e( ms pl)?"),
    ("ms-rl", "microsoft reciprocal", r"microsoft reciprocal licen[cs]e( ms rl)?"),
    ("ecl", "educational community", r"educational community licen[cs]e( version 2 0)?"),
    ("ncsa", "university of illinois", r"university of illinois ncsa open source licen[cs]e"),
    ("nasa", "nasa open source", r"nasa open source agreement"),
    ("cecill", "cecill", r"cecill( [abc])?( free software)? licen[cs]e"),
    ("mulan", "mulan", r"mulan (psl|permissive software licen[cs]e)( v2)?"),
    ("upl", "universal permissive", r"universal permissive licen[cs]e( upl)?( version 1 0)?"),
    ("sspl", "server side public", r"server side public licen[cs]e"),
    ("busl", "business source", r"business source licen[cs]e( 1 1)?"),
    ("elastic", "elastic license", r"elastic license( 2 0)?"),
    ("polyform", "polyform", r"polyform (noncommercial|small business|strict|shield|perimeter|internal use) licen[cs]e"),
    ("commons-clause", "commons clause", r"commons clause licen[cs]e condition"),
    # Creative Commons: names in full, addresses, and the words of the deeds.
    ("cc-by-nc-nd", "creative commons attribution", r"creative commons attribution non ?commercial no ?deriv\w*( works)?( (4|3|2) [05])?"),
    ("cc-by-nc-sa", "creative commons attribution", r"creative commons attribution non ?commercial share ?alike( (4|3|2) [05])?"),
    ("cc-by-nc", "creative commons attribution", r"creative commons attribution non ?commercial( (4|3|2) [05])?"),
    ("cc-by-nd", "creative commons attribution", r"creative commons attribution no ?deriv\w*( works)?( (4|3|2) [05])?"),
    ("cc-by-sa", "creative commons attribution", r"creative commons attribution share ?alike( (4|3|2) [05])?"),
    ("cc-by", "creative commons attribution", r"(this work is )?licensed under (a|the) creative commons attribution( (4|3|2) [05])?( international| unported| generic)? licen[cs]e"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd", r"creativecommons org licenses by nc nd( \d \d)?"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa", r"creativecommons org licenses by nc sa( \d \d)?"),
    ("cc-by-nc", "creativecommons org licenses by nc", r"creativecommons org licenses by nc( \d \d)?"),
    ("cc-by-nd", "creativecommons org licenses by nd", r"creativecommons org licenses by nd( \d \d)?"),
    ("cc-by-sa", "creativecommons org licenses by sa", r"creativecommons org licenses by sa( \d \d)?"),
    ("cc-by", "creativecommons org licenses by", r"creativecommons org licenses by( \d \d)?"),
    ("cc0", "creativecommons org publicdomain zero", r"creativecommons org publicdomain zero( 1 0)?"),
    ("public-domain", "creativecommons org publicdomain mark", r"creativecommons org publicdomain mark( 1 0)?"),
    ("cc0", "waiving all of his or her rights", r"has dedicated the work to the public domain by waiving all of his or her rights"),
    ("cc-by", "share copy and redistribute", r"you are free to share copy and redistribute the material in any medium or format"),
    ("cc-by", "give appropriate credit", r"you must give appropriate credit provide a link to the license and indicate if changes were made"),
    ("cc-by-nc", "material for commercial purposes", r"you may not use the material for commercial purposes"),
    ("cc-by-sa", "contributions under the same license", r"you must distribute your contributions under the same license as the original"),
    ("cc-by-nd", "distribute the modified material", r"you may not distribute the modified material"),
    # Data, fonts, documents.
    ("odbl", "made available under the open database", r"is made available under the open database license"),
    ("odc-by", "open data commons attribution", r"open data commons attribution licen[cs]e( v1 0)?"),
    ("pddl", "public domain dedication and", r"public domain dedication and licen[cs]e"),
    ("ogl", "open government", r"(contains public sector information licensed under the )?open government licen[cs]e( v\d 0)?"),
    ("etalab", "licence ouverte", r"licence ouverte( open licence)?"),
    ("ofl", "this font software is licensed", r"this font software is licensed under the sil open font license"),
    ("ofl", "reserved font name", r"(with )?reserved font name"),
    ("ofl", "font software", r"(neither the )?font software (nor any of its individual components in original or modified versions )?may be sold by itself"),
    ("unicode", "unicode inc license", r"unicode inc license agreement( data files and software)?"),
    ("w3c", "w3c software", r"w3c software (and document )?notice and licen[cs]e"),
    # Single programs.
    ("zlib", "origin of this software", r"the origin of this software must not be misrepresented( you must not claim that you wrote the original software)?"),
    ("zlib", "altered source versions", r"altered source versions must be plainly marked as such"),
    ("zlib", "any express or implied warranty", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("libpng", "png reference library", r"the png reference library is supplied as is"),
    ("ijg", "independent jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", "freetype", r"portions of this software are copyright" + _ANY + r" the freetype project|freetype project licen[cs]e"),
    ("openssl", "openssl toolkit", r"developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", "eric young", r"this product includes cryptographic software written by eric young"),
    ("php", "includes php software", r"this product includes php software freely available from"),
    ("python", "psf is making python", r"psf is making python( \d( \d)*)? available to licensee on an as is basis"),
    ("python", "beopen python", r"beopen python open source licen[cs]e agreement"),
    ("postgresql", "university of california be liable", r"in no event shall the university of california be liable to any party"),
    ("tcl", "authors hereby grant permission", r"the authors hereby grant permission to use copy modify distribute and license this software"),
    ("vim", "vim is charityware", r"vim is charityware"),
    ("beerware", "buy me a beer", r"you can buy me a beer in return"),
    ("json", "for good not evil", r"the software shall be used for good not evil"),
    ("wtfpl", "you just do what the", r"you just do what the \w+ you want to"),
    # No rights reserved, and all of them.
    ("unlicense", "unencumbered software", r"free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("public-domain", "placed in the public domain", r"(has been |is |hereby )?placed in the public domain"),
    ("public-domain", "released into the public domain", r"(has been |is |hereby )?released into the public domain"),
    ("public-domain", "disclaims copyright", r"the authors? disclaims copyright to this source code"),
    ("proprietary", "confidential and proprietary", r"confidential and proprietary( information)?"),
    ("proprietary", "unauthorized copying", r"unauthorized copying of this file( via any medium)? is strictly prohibited"),
    ("proprietary", "no part of this", r"no part of this (publication|document|book|work) may be reproduced( stored in a retrieval system)?"),
    ("proprietary", "may not be reproduced", r"may not be reproduced( copied)?( or)?( distributed)?( in any form)? without (the )?(prior|express)( written)? (permission|consent)"),
    ("proprietary", "end user license agreement", r"end user license agreement( eula)?"),
    ("proprietary", "reverse engineer", r"you (may|shall|must) not reverse engineer decompile or disassemble the software"),
    ("proprietary", "all rights reserved", r"(copyright )?all rights reserved"),
]
