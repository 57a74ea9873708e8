"""Record schemas.  Times are epoch milliseconds (BIGINT) at every boundary."""

from pyspark.sql import types as T

PASSAGE = T.StructType([
    T.StructField("action_time", T.LongType()),
    T.StructField("monitor_id", T.StringType()),
    T.StructField("camera_id", T.StringType()),
    T.StructField("car", T.StringType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("area_id", T.StringType()),
])

VIOLATION = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("msg", T.StringType()),
    T.StructField("create_time", T.LongType()),
])

POLICE_ACTION = T.StructType([
    T.StructField("police_id", T.StringType()),
    T.StructField("car", T.StringType()),
    T.StructField("action_status", T.StringType()),
    T.StructField("action_time", T.LongType()),
])

MONITOR = T.StructType([
    T.StructField("monitor_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("speed_limit", T.IntegerType()),
    T.StructField("area_id", T.StringType()),
])

VIOLATION_LIST = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("violation", T.StringType()),
    T.StructField("create_time", T.LongType()),
])

AREA = T.StructType([
    T.StructField("area_id", T.StringType()),
    T.StructField("area_name", T.StringType()),
])

OVERSPEED = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("monitor_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("real_speed", T.DoubleType()),
    T.StructField("limit_speed", T.IntegerType()),
    T.StructField("action_time", T.LongType()),
])

AVERAGE_SPEED = T.StructType([
    T.StructField("start_time", T.LongType()),
    T.StructField("end_time", T.LongType()),
    T.StructField("monitor_id", T.StringType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("car_count", T.LongType()),
])

TRACK = T.StructType([
    T.StructField("car", T.StringType()),
    T.StructField("action_time", T.LongType()),
    T.StructField("monitor_id", T.StringType()),
    T.StructField("road_id", T.StringType()),
    T.StructField("area_id", T.StringType()),
    T.StructField("speed", T.DoubleType()),
])
