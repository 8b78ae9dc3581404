"""Build gridpanel/data/iso_3166_1.csv from the public ISO 3166-1 list of the
iso-codes package (``/usr/share/iso-codes/json/iso_3166-1.json``).

    python tools/build_iso_table.py [source.json]
"""

import csv
import json
import os
import sys

SRC = sys.argv[1] if len(sys.argv) > 1 else "/usr/share/iso-codes/json/iso_3166-1.json"
DST = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))),
                   "gridpanel", "data", "iso_3166_1.csv")
FIELDS = ["alpha_2", "alpha_3", "numeric", "name", "official_name", "common_name"]

rows = json.load(open(SRC, encoding="utf-8"))["3166-1"]
with open(DST, "w", newline="", encoding="utf-8") as f:
    w = csv.writer(f)
    w.writerow(["country_pos"] + FIELDS)
    for i, r in enumerate(rows):
        w.writerow([i] + [r.get(k, "") for k in FIELDS])
print(f"{len(rows)} rows -> {DST}")
