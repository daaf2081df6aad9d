"""Declared schemas of the input and output tables (FIXTURES §1).

Input checks compare column names and types; the sources hand every operator
DataFrames with exactly these columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

S, D, L, I, F_ = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.FloatType()
DT = T.DateType()
ARR_S = T.ArrayType(T.StringType())


def _schema(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


BEHAVIOR = _schema(("sid", S), ("cla_id", S), ("cla_level_name", S), ("cla_subject_names", S),
                   ("cla_class_type", S), ("cla_teacher_ids", S), ("cla_servicecenter_id", S),
                   ("cla_classtime_ids", S), ("day", DT))
ORDER = _schema(("sid", S), ("distinctid", S), ("orderstatus", I), ("classprice", D), ("classlevelname", S),
                ("subjectname", S), ("startdate", DT), ("finacreatedate", DT), ("dt", DT))
REGIST = _schema(("reg_student_id", S), ("reg_class_id", S), ("reg_pay_date", DT),
                 ("reg_ispay", I), ("reg_isdeleted", I))
USER = _schema(("id", S))
STUDENT = _schema(("stu_id", S), ("stu_uid", S), ("city_id", S), ("stu_grade_id", S))
CLASS = _schema(("cla_id", S), ("city_id", S), ("cla_grade_id", S), ("cla_term_id", S),
                ("cla_subject_names", S), ("cla_level_name", S), ("cla_class_type", S),
                ("cla_year", S), ("cla_subject_ids", L), ("cla_classtime_names", S), ("cla_classdate_name", S))
CURRICULUM = _schema(("cuc_class_id", S), ("cuc_class_date", DT),
                     ("cuc_start_time", S), ("cuc_end_time", S), ("city_id", S))
TOKENS = _schema(("sid", S), ("city_id", S), ("grade_id", S), ("left_rule", ARR_S), ("dt", S))
RULE = _schema(("city_id", S), ("grade_id", S), ("left", ARR_S), ("recall", S))
LOCATION = _schema(("sid", S), ("city_id", S), ("depart_4", S))
REGISTER = _schema(("sid", S), ("cla_id", S), ("cla_term_id", S), ("cla_subject_names", S),
                   ("year", S), ("reg_ispay", S), ("reg_isdeleted", S), ("city_id", S),
                   ("class_dates", S), ("start_times", S), ("end_times", S))
SCORE = _schema(("cla_id", S), ("city_id", S), ("cla_class_type", L), ("cla_subject_names", S),
                ("cla_subject_ids", L), ("cla_term_id", S), ("cla_grade_id", S),
                ("cla_level_name", S), ("cla_classtime_names", S), ("cla_classdate_name", S),
                ("fin_score", D))

FEATURE = _schema(("sid", S), ("feature_name", S), ("value", D), ("dt", S))
LIST_FEATURE = _schema(("sid", S), ("feature_name", S), ("value", S), ("dt", S))


def check(df: DataFrame, schema: T.StructType, name: str = "table") -> DataFrame:
    """Fail early when a required column is missing or has another type; select in order."""
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"{name}: missing columns {missing}")
    wrong = [(f.name, have[f.name].simpleString(), f.dataType.simpleString())
             for f in schema.fields if have[f.name] != f.dataType]
    if wrong:
        raise TypeError(f"{name}: column types differ (column, have, want): {wrong}")
    return df.select(*[f.name for f in schema.fields])
