"""Rule patterns.

All patterns are unanchored "find" regexes evaluated with ``rlike`` (Java
regex) and kept inside the subset that RE2 (DuckDB) reads the same way: no
look-around, no back references.  ``(?i)`` marks a case-insensitive rule.

Each rule keeps its own name; several of them look alike but select
different line sets, so they must never be merged.
"""

# --- fixed values: rule patterns that must match the reference behaviour ---
RX_IP = r"([0-9]{1,3}\.){3}[0-9]{1,3}"
RX_FAILED = r"(?i)Failed password|authentication failure|FAILED LOGIN"
RX_SUSP_PATH = (
    r"(?i)\.env|wp-admin|/admin|/passwd|/config|Invalid user|SENSITIVE PATH|WEB PROBE"
)
RX_HTTP_ERR = '" [45][0-9]{2} '
RX_SRV_ERR = (
    r"(?i)ERROR:|error|Out of memory|Segmentation fault|Disk I/O|Connection refused"
    r"|SYSTEM ERROR"
)
RX_SENS_STAGE3 = r"(?i)\.env|wp-admin|/admin|/passwd"
RX_SENS_APACHE = r"admin|\.env|wp-admin|passwd|config|backup"
RX_WEB_PROBE = r"\.env|wp-admin|/admin|/passwd|/config|/backup"
RX_SSH_BF = r"Failed password|Invalid user|authentication failure"
RX_SYS_ERR = r"ERROR:|Out of memory|Segmentation fault|Disk I/O error"
RX_SUCCESS_LOOSE = r"Accepted|200|201"
RX_SUCCESS_STRICT = 'Accepted password|" 20[01] '
RX_HTTP_4XX = '" 4[0-9]{2} '
RX_HTTP_5XX = '" 5[0-9]{2} '
RX_NORMAL = r"Accepted|200|Started"
RX_ANOMALY = r"Failed|Invalid|ERROR|403|404|500|\.env|wp-admin|admin"

# substrings counted by the stage-3 anomaly table and the detailed alerts
LIT_FAILED_PASSWORD = "Failed password"
LIT_INVALID_USER = "Invalid user"
LIT_ACCEPTED_PASSWORD = "Accepted password"
LIT_ERROR_COLON = "ERROR:"
LIT_ERROR = "ERROR"
LIT_ENV = ".env"
LIT_ADMIN = "/admin"
LIT_WP_ADMIN = "wp-admin"
LIT_OOM = "Out of memory"
LIT_SEGFAULT = "Segmentation"
LIT_DISK_IO = "Disk I/O"

# time layouts of the two log framings
SYSLOG_TIME_FORMAT = "yyyy MMM d HH:mm:ss"
APACHE_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss Z"

# anomaly-scan rule labels, in rule order
SCAN_SSH = "SSH Brute Force"
SCAN_WEB = "Web Probing"
SCAN_HTTP = "HTTP Errors"
SCAN_SYS = "System Errors"

# stage-3 anomaly table rows, in print order
ANOMALY_FAILED_SSH = "Failed SSH Logins"
ANOMALY_INVALID = "Invalid User Attempts"
ANOMALY_HTTP = "HTTP 4xx/5xx Errors"
ANOMALY_SYSTEM = "System Errors"
ANOMALY_SENSITIVE = "Sensitive Path Hits"
TOTAL = "TOTAL"

# source file names and their log types
SOURCE_FILES = {
    "auth.log": "auth",
    "syslog": "syslog",
    "apache.log": "apache",
    "sample_logs.log": "sample",
}
DERIVED_SOURCE_FILES = ("sample_logs.log",)
# --- end of fixed values ---
