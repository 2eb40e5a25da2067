"""Licence texts and notices that scans look for, with their labels.

Fixed values: all texts are as their publishers word them. Whole licences come
first; heads are openings and clauses that several licences share, which count
where no whole text is there.
"""

_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN "
    "AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE "
    "OR OTHER DEALINGS IN THE SOFTWARE."
)
_MIT_GRANT = (
    'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated '
    'documentation files (the "Software"), to deal in the Software without restriction, including without '
    "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
    "Software"
)
_MIT_PERSONS = "and to permit persons to whom the Software is furnished to do so"

_ISC_GRANT = ("Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
              "is hereby granted")
_ISC_AS_IS = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, "
    "DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN "
    "CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)

_BSD_GRANT = ("Redistribution and use in source and binary forms, with or without modification, are permitted "
              "provided that the following conditions are met")
_BSD_SOURCE = ("Redistributions of source code must retain the above copyright notice, this list of conditions and "
               "the following disclaimer.")
_BSD_BINARY = (
    "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution."
)
_BSD_ADVERTISING = (
    "All advertising materials mentioning features or use of this software must display the following "
    "acknowledgement: This product includes software developed by"
)
_BSD_NAMES = (
    "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission."
)
_BSD_AS_IS = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH "
    "DAMAGE."
)

_APACHE_1 = (
    "The end-user documentation included with the redistribution, if any, must include the following "
    'acknowledgment: "This product includes software developed by the Apache Software Foundation '
    '(http://www.apache.org/)." Alternately, this acknowledgment may appear in the software itself, if and wherever '
    "such third-party acknowledgments normally appear."
)
_APACHE_1_NAMES = (
    'The names "Apache" and "Apache Software Foundation" must not be used to endorse or promote products derived '
    "from this software without prior written permission. For written permission, please contact apache@apache.org. "
    'Products derived from this software may not be called "Apache", nor may "Apache" appear in their name, without '
    "prior written permission of the Apache Software Foundation."
)

_UNLICENSE = (
    "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, "
    "use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any "
    "purpose, commercial or non-commercial, and by any means."
)

_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held "
    "liable for any damages arising from the use of this software. Permission is granted to anyone to use this "
    "software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject "
    "to the following restrictions: The origin of this software must not be misrepresented; you must not claim that "
    "you wrote the original software. If you use this software in a product, an acknowledgment in the product "
    "documentation would be appreciated but is not required. Altered source versions must be plainly marked as such, "
    "and must not be misrepresented as being the original software. This notice may not be removed or altered from any "
    "source distribution."
)

_BOOST = (
    "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and "
    'accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, '
    "execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties "
    "to whom the Software is furnished to do so"
)

WHOLE = (
    ("mit", f"{_MIT_GRANT}, {_MIT_PERSONS}, subject to the following conditions: The above copyright notice and this "
            "permission notice shall be included in all copies or substantial portions of the Software. " + _AS_IS),
    ("mit-0", f"{_MIT_GRANT}, {_MIT_PERSONS}. {_AS_IS}"),
    ("isc", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all "
            f"copies. {_ISC_AS_IS}"),
    ("0bsd", f"{_ISC_GRANT}. {_ISC_AS_IS}"),
    ("bsd-2", f"{_BSD_GRANT}: {_BSD_SOURCE} {_BSD_BINARY} {_BSD_AS_IS}"),
    ("bsd-3", f"{_BSD_GRANT}: {_BSD_SOURCE} {_BSD_BINARY} {_BSD_NAMES} {_BSD_AS_IS}"),
    ("bsd-4", f"{_BSD_GRANT}: {_BSD_SOURCE} {_BSD_BINARY} {_BSD_ADVERTISING} the organization. {_BSD_NAMES} {_BSD_AS_IS}"),
    ("apache-1.1", f"{_BSD_GRANT}: {_BSD_SOURCE} {_BSD_BINARY} {_APACHE_1} {_APACHE_1_NAMES}"),
    ("unlicense", f"{_UNLICENSE} In jurisdictions that recognize copyright laws, the author or authors of this software "
                  "dedicate any and all copyright interest in the software to the public domain."),
    ("zlib", _ZLIB),
    ("bsl-1", _BOOST),
)

# What stands at the top of files, and statements of a licence by its name.
NOTICES = (
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use "
                 "this file except in compliance with the License. You may obtain a copy of the "
                 "License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("apache-2", "Licensed under the Apache License, Version 2.0"),
    ("gpl-3", "licensed under the GNU General Public License, version 3"),
    ("gpl-3", "under the terms of the GNU General Public License as published by the Free Software "
              "Foundation, either version 3 of the License, or (at your option) any later version"),
    ("gpl-2", "under the terms of the GNU General Public License as published by the Free Software "
              "Foundation; either version 2 of the License, or (at your option) any later version"),
    ("gpl-2", "under the terms of the GNU General Public License version 2 as published by the Free Software Foundation"),
    ("gpl-2", "licensed under the GNU General Public License, version 2"),
    ("lgpl-3", "licensed under the GNU Lesser General Public License, version 3"),
    ("lgpl-2.1", "licensed under the GNU Lesser General Public License, version 2.1"),
    ("lgpl-2", "licensed under the GNU Library General Public License, version 2"),
    ("agpl-3", "licensed under the GNU Affero General Public License, version 3"),
    *((label, f"under the terms of the GNU {name} General Public License as published by the Free "
              f"Software Foundation, either version {version} of the License, or (at your option) "
              "any later version")
      for label, name, version in (
          ("lgpl-3", "Lesser", "3"), ("lgpl-2.1", "Lesser", "2.1"), ("lgpl-2", "Library", "2"),
          ("agpl-3", "Affero", "3"))),
    *((label, f"{name} v{version} or later")
      for label, name, version in (
          ("gpl-2", "GPL", 2), ("gpl-3", "GPL", 3), ("lgpl-3", "LGPL", 3), ("agpl-3", "AGPL", 3))),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsl-1", "Distributed under the Boost Software License, Version 1.0"),
    ("epl-2", "made available under the terms of the Eclipse Public License 2.0"),
)

_CC_NAMES = (
    ("", ""), ("-nc", "-NonCommercial"), ("-sa", "-ShareAlike"), ("-nc-sa", "-NonCommercial-ShareAlike"))

CREATIVE_COMMONS = (
    *((f"cc-by{label}", f"licensed under a Creative Commons Attribution{name} 4.0 International License")
      for label, name in (
          *_CC_NAMES, ("-nd", "-NoDerivatives"), ("-nc-nd", "-NonCommercial-NoDerivatives"))),
    *((f"cc-by{label}-{version}",
       f"licensed under a Creative Commons Attribution{name} {version}{unported} License")
      for version, unported in (("3.0", " Unported"), ("3.0", ""), ("2.5", ""), ("2.0", ""))
      for label, name in (*_CC_NAMES, ("-nd", "-NoDerivs"), ("-nc-nd", "-NonCommercial-NoDerivs"))),
    ("cc0", "dedicated to the public domain under the Creative Commons CC0 1.0 Universal"),
)

# Identifiers of files, and the labels used here.
_IDENTIFIERS = (
    ("MIT", "mit"), ("MIT-0", "mit-0"), ("ISC", "isc"), ("0BSD", "0bsd"), ("BSD-2-Clause", "bsd-2"),
    ("BSD-3-Clause", "bsd-3"), ("BSD-4-Clause", "bsd-4"), ("Apache-1.1", "apache-1.1"), ("Apache-2.0", "apache-2"),
    ("GPL-2.0", "gpl-2"), ("GPL-3.0", "gpl-3"), ("LGPL-2.0", "lgpl-2"), ("LGPL-2.1", "lgpl-2.1"),
    ("LGPL-3.0", "lgpl-3"), ("AGPL-3.0", "agpl-3"), ("MPL-2.0", "mpl-2"), ("Unlicense", "unlicense"),
    ("Zlib", "zlib"), ("BSL-1.0", "bsl-1"), ("EPL-2.0", "epl-2"), ("CC0-1.0", "cc0"), ("CC-BY-4.0", "cc-by"),
    ("CC-BY-SA-4.0", "cc-by-sa"), ("CC-BY-NC-4.0", "cc-by-nc"), ("CC-BY-ND-4.0", "cc-by-nd"),
    ("CC-BY-NC-SA-4.0", "cc-by-nc-sa"), ("CC-BY-NC-ND-4.0", "cc-by-nc-nd"),
)
IDENTIFIERS = tuple((label, f"SPDX-License-Identifier: {name}") for name, label in _IDENTIFIERS)

TEMPLATES = (*WHOLE, *NOTICES, *CREATIVE_COMMONS, *IDENTIFIERS)

# Openings and clauses on their own. The first is that of both licences.
HEADS = (
    ("mit", _MIT_GRANT),
    ("isc", f"{_ISC_GRANT}, provided that the above copyright notice and this permission notice appear in all copies"),
    ("isc-or-0bsd", _ISC_GRANT),
    ("bsd", _BSD_GRANT),
    ("bsd-3", _BSD_NAMES),
    ("bsd-4", _BSD_ADVERTISING),
    ("unlicense", _UNLICENSE),
)
