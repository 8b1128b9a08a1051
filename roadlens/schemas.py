"""Fixed schemas and fixed values of the vehicle-log data model."""

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the original programs' values for equal results)
# ---------------------------------------------------------------------------
# vehicle-log text time format and the stream log's time format
LOG_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"
STREAM_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
# the dirty record written into the live stream
ILLEGAL_LOG = "ILLEGAL_LOG"
# over-speed threshold (strict >)
OVER_SPEED = 250
# number of rows of every top-k report; recommendations per person
TOP_K = 10
TOP_N_FRIENDS = 2
# trace text: "<time> @ <monitor>" joined by "->"
TRACE_POINT_SEP = " @ "
TRACE_STEP_SEP = "->"
# text of a missing time or monitor in a trace
TRACE_MISSING = "null"
# congestion levels by average speed: <=5 jammed, <=10 severe, <=30 slow, else normal
CONGESTION_LEVELS = ((5, "jammed"), (10, "severe"), (30, "slow"))
CONGESTION_DEFAULT = "normal"
# sliding windows: vehicle speed 60 s / 5 s; token count 15 s / 10 s
SPEED_WINDOW, SPEED_SLIDE = "60 seconds", "5 seconds"
TOKEN_WINDOW, TOKEN_SLIDE = "15 seconds", "10 seconds"
# ---------------------------------------------------------------------------

# Column names of the vehicle log (one row = one camera reading)
DATE_TIME = "dateTime"
PLATE = "vehiclePlate"
SPEED = "vehicleSpeed"
ROAD = "roadId"
MONITOR = "monitorId"
CAMERA = "cameraId"

VEHICLE_LOG = T.StructType([
    T.StructField(DATE_TIME, T.StringType()),
    T.StructField(PLATE, T.StringType()),
    T.StructField(SPEED, T.IntegerType()),
    T.StructField(ROAD, T.StringType()),
    T.StructField(MONITOR, T.StringType()),
    T.StructField(CAMERA, T.StringType()),
])

RELATIONSHIP = T.StructType([
    T.StructField(ROAD, T.StringType()),
    T.StructField(MONITOR, T.StringType()),
    T.StructField(CAMERA, T.StringType()),
])

# Temp-view names used by the SQL forms
LOG_VIEW = "t_vehicle_log"
RELATIONSHIP_VIEW = "t_road_monitor_camera_relationship"
