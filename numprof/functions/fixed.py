"""Texts, names and limits that results must carry exactly.

Kept together and in plain text; every operator imports them from here.
"""

# Band labels and the default band edges (strict comparisons).
HIGH = "high"
LOW = "low"
MEDIUM = "medium"
DEFAULT_LOW_EDGE = -1.0
DEFAULT_HIGH_EDGE = 1.0

# The three result key spaces (the ``engine`` partition values).
GPU = "gpu_processed"
RDD = "spark_rdd"
DATAFRAME = "spark_dataframe"
ENGINES = (GPU, RDD, DATAFRAME)

# ``processing_type`` of the two profile kinds; also the method names.
RDD_NAME = "RDD"
DATAFRAME_NAME = "DataFrame"

# Array requests: the one implemented type, defaults, statuses and errors.
NORMALIZE = "normalize"
UNKNOWN_JOB = "unknown"
SUCCESS = "success"
ERROR = "error"
NO_DATA_ERROR = "No data provided"
UNSUPPORTED_TYPE_ERROR = "Processing failed: unsupported type "
UNUSABLE_DATA_ERROR = "Processing failed: data is not an array of numbers"

# Job analysis.
COMPLETED = "completed"
FAILED = "failed"
MISSING_ERROR = "Missing results for comparison"
MISSING_ADVICE = "Unable to generate recommendations due to missing results"
DATAFRAME_ADVICE = ("Use DataFrame API for ", "% better performance")
RDD_ADVICE = ("RDD API showed ", "% better performance for this dataset")
LARGE_ADVICE = ("Consider using more partitions for large datasets",
                "Enable adaptive query execution for better resource utilization")
LARGE_RECORDS = 100000
LABEL_CHARS = 8

# Chart series.
TIME_CHART = "time_comparison"
SPEEDUP_CHART = "speedup"
BASELINE = "Baseline"
