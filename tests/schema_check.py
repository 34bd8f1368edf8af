"""Spark result types vs DuckDB twin types for every registered query (run: python tests/schema_check.py)."""
import sys
sys.path.insert(0, __file__.rsplit("/", 2)[0])
import __spark_entry__ as E
from tests.oracle import duck
from poolwright.session import local_session
spark=local_session()
SF="/root/testdata/sf0.001"
con=duck(SF)
fam_spark={"string":"str","int":"int32","bigint":"int64","boolean":"bool","date":"date","timestamp_ntz":"ts","timestamp":"ts","double":"f64","smallint":"int16"}
fam_duck={"VARCHAR":"str","INTEGER":"int32","BIGINT":"int64","BOOLEAN":"bool","DATE":"date","TIMESTAMP":"ts","DOUBLE":"f64","HUGEINT":"int128","SMALLINT":"int16"}
bad=0
for name, fn in E.queries().items():
    if name not in E.oracle_sql():
        continue
    df=fn(spark,SF)
    s={f.name: fam_spark.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    rel=con.execute("DESCRIBE " + E.oracle_sql()[name]).fetchall()
    d={r[0]: fam_duck.get(r[1], r[1]) for r in rel}
    diff={k:(s.get(k),d.get(k)) for k in set(s)|set(d) if s.get(k)!=d.get(k)}
    if diff:
        bad+=1; print(name, diff, flush=True)
print("queries with type differences:", bad)
