"""Print the formatted plan of one query: python tools/explain.py <sf_dir> <query>"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from citylake.catalog.all import QUERIES  # noqa: E402
from citylake.session import build_session  # noqa: E402

spark = build_session("explain", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false")
spark.sparkContext.setLogLevel("ERROR")
QUERIES[sys.argv[2]](spark, sys.argv[1]).explain(sys.argv[3] if len(sys.argv) > 3 else "simple")
