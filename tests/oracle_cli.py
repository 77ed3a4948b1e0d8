"""Run every query against its DuckDB twin at one scale and print one JSON line per query.

    python tests/oracle_cli.py /root/testdata/sf0.01 [key,key,...]
    ORACLE_EXACT=1 python tests/oracle_cli.py ...   # compare doubles bit for bit
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import __spark_entry__ as E  # noqa: E402
from linfold.session import local_session  # noqa: E402
from oracle import compare, duck  # noqa: E402


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2].split(",")) if len(argv) > 2 else None
    spark = local_session(8)
    con = duck(sf)
    sqls = E.oracle_sql()
    for key, query in E.queries().items():
        if only and key not in only:
            continue
        t = time.time()
        try:
            if key in sqls:
                r = compare(spark, con, key, query, sqls[key], sf)
            else:
                df = query(spark, sf)
                r = {"key": key, "rows_only": df.count(), "cols": df.columns}
        except Exception as e:  # report and go on with the next query
            r = {"key": key, "error": repr(e)[:500]}
        r["sec"] = round(time.time() - t, 2)
        print(json.dumps(r, default=str), flush=True)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
