"""Wordings of widely used licences and notices, and their labels."""

_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files (the \"Software\"), to deal in the Software without restriction"
)
_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED "
    "TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL "
    "THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
    "DEALINGS IN THE SOFTWARE."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met"
)
_BSD_TWO = (
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of "
    "conditions and the following disclaimer in the documentation and/or other materials provided with the "
    "distribution."
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, "
    "INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY "
    "THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING "
    "IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

NOTICES = (
    ("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at",
    ),
    ("mit", "Released under the MIT License"),
    ("mit", "Licensed under the MIT License"),
    ("mit", _MIT_GRANT),
    ("bsd", _BSD_START),
    ("bsd", "This project is licensed under the BSD 3-Clause License"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "lgpl",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
        "published by the Free Software Foundation",
    ),
    (
        "agpl",
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
        "published by the Free Software Foundation",
    ),
    ("agpl", "This work is licensed under the GNU Affero General Public License"),
    (
        "gfdl",
        "Permission is granted to copy, distribute and/or modify this document under the terms of the GNU Free "
        "Documentation License",
    ),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    (
        "epl-2.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at",
    ),
    (
        "cddl",
        "The contents of this file are subject to the terms of the Common Development and Distribution License",
    ),
    ("eupl", "Licensed under the European Union Public Licence"),
    ("artistic-2.0", "is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0"),
    ("ofl", "This Font Software is licensed under the SIL Open Font License, Version 1.1"),
    ("bsl-1.0", "Distributed under the Boost Software License, Version 1.0"),
    ("ms-pl", "This code is released under the Microsoft Public License"),
    ("psf", "Licensed to PSF under a Contributor Agreement"),
    ("odbl", "made available under the Open Database License"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc-by-nc-sa", "Licensed under CC BY-NC-SA 4.0"),
    ("cc-by-nc-nd", "Licensed under CC BY-NC-ND 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights"),
    ("reserved", "All rights reserved. No part of this publication may be reproduced without permission"),
)

BODIES = (
    (
        "mit",
        f"{_MIT_GRANT}, including without limitation the rights to use, copy, modify, merge, publish, distribute, "
        "sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do "
        "so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        f"included in all copies or substantial portions of the Software. {_DISCLAIMER}",
    ),
    ("bsd", f"{_BSD_START}: {_BSD_TWO} {_BSD_DISCLAIMER}"),
    ("bsd", f"{_BSD_START}: {_BSD_TWO} {_BSD_THIRD} {_BSD_DISCLAIMER}"),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies. THE "
        "SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING "
        "ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, "
        "DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR "
        "PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
        "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "zlib",
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be "
        "held liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
        "software for any purpose, including commercial applications, and to alter it and redistribute it freely, "
        "subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not "
        "claim that you wrote the original software. If you use this software in a product, an acknowledgment in the "
        "product documentation would be appreciated but is not required. 2. Altered source versions must be plainly "
        "marked as such, and must not be misrepresented as being the original software. 3. This notice may not be "
        "removed or altered from any source distribution.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, "
        "for any purpose, commercial or non-commercial, and by any means.",
    ),
    (
        "bsl-1.0",
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software "
        "and accompanying documentation covered by this license (the \"Software\") to use, reproduce, display, "
        "distribute, execute, and transmit the Software, and to prepare derivative works of the Software",
    ),
    (
        "wtfpl",
        "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and "
        "changing it is allowed as long as the name is changed.",
    ),
    (
        "gpl",
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the "
        "implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License "
        "for more details. You should have received a copy of the GNU General Public License along with this program.",
    ),
)

#: Identifiers of SPDX tags by label; a tag is "SPDX-License-Identifier: " and an identifier.
IDENTIFIERS = {
    "agpl": ("AGPL-3.0-only", "AGPL-3.0-or-later"),
    "apache-2.0": ("Apache-2.0",),
    "artistic-2.0": ("Artistic-2.0",),
    "bsd": ("BSD-2-Clause", "BSD-3-Clause"),
    "bsl-1.0": ("BSL-1.0",),
    "cc-by": ("CC-BY-4.0",),
    "cc-by-nc": ("CC-BY-NC-4.0",),
    "cc-by-nc-nd": ("CC-BY-NC-ND-4.0",),
    "cc-by-nc-sa": ("CC-BY-NC-SA-4.0",),
    "cc-by-nd": ("CC-BY-ND-4.0",),
    "cc-by-sa": ("CC-BY-SA-4.0",),
    "cc0": ("CC0-1.0",),
    "cddl": ("CDDL-1.0",),
    "cecill": ("CECILL-2.1",),
    "epl-2.0": ("EPL-2.0",),
    "eupl": ("EUPL-1.2",),
    "gpl": ("GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later"),
    "isc": ("ISC",),
    "lgpl": ("LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"),
    "mit": ("MIT",),
    "mpl-2.0": ("MPL-2.0",),
    "ms-pl": ("MS-PL",),
    "ncsa": ("NCSA",),
    "odbl": ("ODbL-1.0",),
    "ofl": ("OFL-1.1",),
    "openssl": ("OpenSSL",),
    "postgresql": ("PostgreSQL",),
    "psf": ("PSF-2.0",),
    "unlicense": ("Unlicense",),
    "upl": ("UPL-1.0",),
    "wtfpl": ("WTFPL",),
    "zlib": ("Zlib",),
    "zpl": ("ZPL-2.1",),
}

TEMPLATES = (*NOTICES, *BODIES)
TAGS = tuple((label, f"SPDX-License-Identifier: {name}") for label, names in IDENTIFIERS.items() for name in names)
