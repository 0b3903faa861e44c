"""Licence wordings by family, and sentences that only look like them.

Fixed values: usual public notices and opening paragraphs of the licences."""

TEMPLATES = {
    "agpl": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        "Licensed under the AGPL-3.0.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "apache": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "See the License for the specific language governing permissions and limitations under the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Licensed under the BSD 3-Clause License.",
        "Released under the BSD License.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "cc0": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",
        "Released under CC0.",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Available under the Creative Commons Attribution License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0.",
        "Licensed under CC BY-NC-ND 4.0.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GPL-3.0.",
        "Licensed under the GNU GPL, version 2 or later.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ],
    "isc": [
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "lgpl": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        "Licensed under the LGPL-2.1.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "Licensed under the MPL-2.0.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright (c) Example Corporation. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ],
    "unlicense": [
        "Released under the Unlicense.",
        "This is free and unencumbered software released into the public domain.",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, for any purpose, commercial or non-commercial, and by any means.",
    ],
}

OTHERS = [
    "The driver lost the license after the accident.", "A fishing license is sold at the counter.",
    "The new version of the program was released in May.", "All members of the public are free to enter.",
    "The right to use the road is reserved for buses.", "Version 2 of the report is in the library.",
    "The company was granted permission to build.", "She has rights under the law.",
    "Copy the file to the folder and modify the name.", "The software works without any restriction.",
    "Apache tribes lived in the southwest.", "He studied at MIT and later at a public school.",
    "The commons were open to all.", "You may not enter except in the company of a member.",
    "The source of the river is in the hills.", "Any person may ask for a copy of the notice.",
    "The general public was not informed.", "The conditions are met by few.",
]
