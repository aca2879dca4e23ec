"""Thresholds and alert wording.

A frozen dataclass is the extension point: callers pass their own
``Thresholds`` instead of editing code.  Every rule reads its bounds from
it, so one query with other bounds exercises every branch of a rule.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class Thresholds:
    # --- fixed values: default bounds of the rules ---
    failed_login: int = 5          # failed logins per IP before an alert
    error: int = 10                # server errors before an alert
    request: int = 100             # requests per IP before suspicion
    tiers: tuple[int, int, int] = (20, 10, 5)   # CRITICAL, HIGH, MEDIUM occurrences
    warn_pct: int = 80             # threshold check: WARNING from this percent
    ssh_extreme: int = 50          # detailed SSH tiers: EXTREME, CRITICAL, (failed_login), MEDIUM
    ssh_critical: int = 20
    ssh_medium: int = 2
    invalid_users: int = 5         # invalid-user alert when count is above this
    web_5xx: tuple[int, int] = (20, 10)     # CRITICAL, HIGH
    web_4xx: tuple[int, int] = (30, 10)     # HIGH, MEDIUM
    admin_probe: int = 5           # /admin alert when hits are above this
    error_storm: int = 50          # system error storm: CRITICAL from here, HIGH from ``error``
    top_ips: int = 11              # digest: IP rows under the 4 heading lines of ``head -15``
    # --- end of fixed values ---
    syslog_year: int = 2024        # syslog lines carry no year


    def replaced(self, values: dict) -> "Thresholds":
        """A copy with other bounds; values may be text (``"20,10,5"`` for a tuple)."""
        kinds = {f.name: f.default for f in fields(self)}
        changed = {}
        for name, value in values.items():
            if name not in kinds:
                raise ValueError(f"no such bound: {name} (known: {', '.join(sorted(kinds))})")
            if isinstance(kinds[name], tuple):
                parts = value.split(",") if isinstance(value, str) else value
                changed[name] = tuple(int(x) for x in parts)
                if len(changed[name]) != len(kinds[name]):
                    raise ValueError(f"{name} takes {len(kinds[name])} values")
            else:
                changed[name] = int(value)
        return replace(self, **changed)


DEFAULT = Thresholds()

# --- fixed values: alert wording (message and action templates) ---
# ``{ip}``, ``{n}`` and ``{t}`` are filled with column values via format_string.
STAGE4_BRUTE_FORCE = "BRUTE FORCE DETECTED | IP: {ip} | Failed Logins: {n} (threshold: {t})"
STAGE4_ELEVATED = "Elevated failures | IP: {ip} | Count: {n}"
STAGE4_ERROR_RATE = "HIGH ERROR RATE | Total Errors: {n} (threshold: {t})"
STAGE4_ERRORS_NORMAL = "Server errors normal: {n}"
STAGE4_SUSPICIOUS_CRIT = "SUSPICIOUS IP | {ip} | {n} occurrences | Risk: CRITICAL"
STAGE4_SUSPICIOUS_HIGH = "Suspicious IP | {ip} | {n} occurrences | Risk: HIGH"

SSH_EXTREME = ("EXTREME brute force from {ip} — {n} attempts",
               "Block IP immediately: sudo ufw deny from {ip}")
SSH_CRITICAL = ("Brute force attack from {ip} — {n} attempts",
                "Block IP: sudo ufw deny from {ip} to any port 22")
SSH_HIGH = ("Elevated failed logins from {ip} — {n} attempts",
            "Monitor IP and consider blocking port 22 access")
SSH_MEDIUM = ("Multiple failed logins from {ip} — {n} attempts",
              "Watch this IP for further activity")
SSH_INVALID = ("Invalid user attempts detected — {n} tries",
               "Check for username enumeration attack")
WEB_5XX_CRIT = ("Massive server errors — {n} HTTP 5xx responses",
                "Check web server logs and application health immediately")
WEB_5XX_HIGH = ("High server error rate — {n} HTTP 5xx responses",
                "Investigate application errors in apache/nginx logs")
WEB_4XX_HIGH = ("Excessive client errors — {n} HTTP 4xx responses",
                "Possible scanning or probing activity — review access logs")
WEB_4XX_MED = ("Elevated client errors — {n} HTTP 4xx responses",
               "Monitor for scanning patterns")
WEB_ENV = (".env file probed {n} times — credentials may be targeted",
           "Ensure .env is not web-accessible. Block probing IP.")
WEB_ADMIN = ("Admin panel probed {n} times",
             "Enable rate limiting on /admin. Consider IP whitelist.")
WEB_WP = ("WordPress admin probed {n} times",
          "Block wp-admin access from unknown IPs")
SYS_STORM = ("System error storm — {n} errors logged",
             "Immediate investigation required — check all services")
SYS_HIGH = ("High system error count — {n} errors",
            "Review error logs: cat server_errors")
SYS_OOM = ("Out of memory errors — {n} occurrences",
           "Check memory usage: free -h. Consider adding swap or RAM.")
SYS_SEGFAULT = ("Segmentation faults — {n} occurrences",
                "Check for corrupted binaries or memory issues")
SYS_DISK = ("Disk I/O errors — {n} occurrences",
            "Check disk health: sudo smartctl -a /dev/sda")
REPUTATION = ("IP {ip} flagged CRITICAL — {n} total suspicious events",
              "Block this IP: sudo ufw deny from {ip}")

# digest texts
STATUS_ACTION = "ACTION REQUIRED — Critical threats detected!"
STATUS_NORMAL = "System operating normally"
ACTIONS_CRITICAL = (
    "Review critical_alerts.txt immediately",
    "Block suspicious IPs using your firewall",
    "Check server error logs for root cause",
    "Run the threshold scan",
)
ACTIONS_NORMAL = (
    "Continue monitoring normally",
    "Review warning alerts when convenient",
)

# threshold table rows (metric label, Thresholds attribute)
THRESHOLD_ROWS = (
    ("Failed SSH logins per IP", "failed_login"),
    ("Server errors total", "error"),
    ("HTTP requests per IP", "request"),
)
# --- end of fixed values ---
