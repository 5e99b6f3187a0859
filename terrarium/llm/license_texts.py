"""Licence notices that the scan looks for.

Fixed values: wording of public licences and of their usual short notices,
as (label, template name, text)."""

PHRASES = [
    ("gpl", "gnu general public license"),
    ("apache", "apache license"),
    ("cc-by", "cc by"),
    ("mit", "mit license"),
]

MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without
limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software,
and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above
copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE
WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR
COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR
OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the
distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR
PURPOSE ARE DISCLAIMED."""

ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
granted, provided that the above copyright notice and this permission notice appear in all copies."""

APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in
compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless
required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS"
BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
governing permissions and limitations under the License."""

GNU = """This program is free software: you can redistribute it and/or modify it under the terms of the GNU {name} as
published by the Free Software Foundation, either version {version} of the License, or (at your option) any later
version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details."""

MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was
not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""

UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify,
publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any
purpose, commercial or non-commercial, and by any means."""

CREATIVE = """This work is licensed under the Creative Commons {name} 4.0 International License. To view a copy of this
license, visit http://creativecommons.org/licenses/{code}/4.0/"""

TEMPLATES = [
    ("mit", "mit-text", MIT),
    ("mit", "mit-line", "Released under the MIT License"),
    ("bsd", "bsd-text", BSD_2),
    ("isc", "isc-text", ISC),
    ("apache", "apache-notice", APACHE),
    ("apache", "apache-line", "Licensed under the Apache License, Version 2.0"),
    ("gpl", "gpl-notice", GNU.format(name="General Public License", version="3")),
    ("gpl", "gpl-line", "This work is licensed under the GNU General Public License, version 3"),
    ("lgpl", "lgpl-notice", GNU.format(name="Lesser General Public License", version="3")),
    ("agpl", "agpl-notice", GNU.format(name="Affero General Public License", version="3")),
    ("mpl", "mpl-notice", MPL),
    ("unlicense", "unlicense-text", UNLICENSE),
    ("cc-by", "cc-by-notice", CREATIVE.format(name="Attribution", code="by")),
    ("cc-by-sa", "cc-by-sa-notice", CREATIVE.format(name="Attribution-ShareAlike", code="by-sa")),
    ("cc-by-nc", "cc-by-nc-notice", CREATIVE.format(name="Attribution-NonCommercial", code="by-nc")),
    ("cc-by-sa", "cc-by-sa-line", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "cc-by-nc-line", "Licensed under CC BY-NC 4.0"),
    ("all-rights-reserved", "rights-line", "All rights reserved"),
]
