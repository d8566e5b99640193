"""Fixed values.

Code tables, positions, word lists and titles that reports and loaders must agree on.  They are
data, not logic: everything that uses them takes them as a default argument.
"""

# Codes of the user directory.
GENDER_LABELS = {2: "None", 1: "Female", 0: "Male"}
ASTRONOMY_LABELS = {1: "Astronomy", 0: "Non-astronomy"}
STUDENT_LABELS = {1: "Student", 0: "Staff"}
NATIONAL_COUNTRY = "AU"
NATIONAL_LABEL = "National Astronomy"
OTHER_LABEL = "Other"
MALE, FEMALE, ASTRONOMY, STUDENT = 0, 1, 1, 1

# Codes of the legacy directory and of the roster file.
LEGACY_GENDER_LABELS = {2: "Male", 1: "Female", 0: "None"}
ROSTER_GENDER_LABELS = {"M": "Male", "F": "Female", "-": "None"}
ROSTER_STUDENT_FLAGS = {"Y": 1, "N": 0}

# Accounting systems, home department, project prefix and accounts that are never charged.
EVENT_SYSTEM = 1
EXTRACT_SYSTEM = 2
HOME_DEPARTMENT_ID = 6
EXTRACT_PROJECT_PREFIX = "oz"
DISCARDED_ACCOUNTS = ("hpcadmin", "testers", "root")

# Event log: object and event type of a finished job, and 0-based token positions.
JOB_OBJECT = "job"
JOB_END = "JOBEND"
EVENT_TOKENS = {
    "time_and_id": 1,
    "object": 2,
    "job_id": 3,
    "type": 4,
    "nodes": 5,
    "cpus": 6,
    "user": 7,
    "group": 8,
    "reqwall": 9,
    "queue": 11,
    "submit_time": 12,
    "start_time": 14,
    "end_time": 15,
    "features": 22,
    "qos": 26,
    "account": 28,
    "partition": 33,
    "memory": 37,
    "rsv": 43,
    "eligible_time": 55,
}
EVENT_LINE_TOKENS = 56

# Dataset families: first substring found wins; anything else is ready-made.
DATASET_FAMILIES = (
    ("multidark", "Multidark"),
    ("vishnu_bolshoi", "Vishnu Bolshoi"),
    ("bolshoi_planck", "Bolshoi Planck"),
    ("bolshoi", "Bolshoi"),
    ("millennium", "Millennium"),
)
READY_MADE_FAMILY = "Ready-Made"

# Roster institution code -> directory institution code.
INSTITUTION_CODES = {
    "SUT": "Swinburne", "MON": "monash", "MEL": "UM", "SYD": "sydney", "UQ": "UQ", "MQ": "MQ",
    "ANU": "ANU", "UWA": "UWA", "AAO": "AAO", "TAS": "UTAS", "VRJ": "vrije", "KUM": "Kumamoto",
    "NAG": "Nagoya", "PAD": "unipd", "LYN": "Lyon", "NRL": "NRL", "RRI": "RRI",
    "MAN": "manchester", "BON": "bonn", "GLA": "GLA", "AUT": "aut", "CSI": "CSIRO",
    "NMS": "NMSU", "INA": "INA", "CAM": "cambridge", "STA": "Stanford", "IND": "IND",
    "UMB": "UMB", "ETH": "ETHZ", "NIR": "astron", "TOR": "toronto", "UCS": "ucsc",
    "TAM": "TAMU", "UCD": "ucdavis", "YAL": "YAL", "PMH": "Portsmouth", "TUB": "TUB",
    "GGU": "GGU", "LED": "leiden", "TOK": "TOK", "CUR": "curtin", "UCB": "UCB", "WVU": "WVU",
    "MPI": "MPI", "NSW": "UNSW",
}

# Report wording.
TITLE_INSTITUTION_USAGE = "Usage by Institution"
TITLE_ACCOUNT_HOLDERS = "Astronomy account holders(total/active for quarter)"
TITLE_ASTRONOMERS = "Institutions other than {home} with astronomy account holders"
TITLE_PROJECT_USAGE = "Share of CPU hours usage by project"
TITLE_DEMOGRAPHIC = "Usage by Demographic"
TITLE_DATASET_USAGE = "General {service} Usage (total for {start} to {end})"
TITLE_DATASET_FAMILIES = "General Data access breakdown per database ({start} to {end})"
LABEL_ALL, LABEL_MALE, LABEL_FEMALE, LABEL_STUDENT = "All", "Male", "Female", "PhD Student"
LABEL_JOBS = "Number of jobs"
LABEL_ACTIVE_USERS = "Number of active users"
LABEL_RECORDS = "Total records returned"
LABEL_SIZE = "Total data-size returned"
LABEL_REGISTERED = "Registered users"
