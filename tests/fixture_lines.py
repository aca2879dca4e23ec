"""Literal test lines shaped like the reference's main fixture.

Built from the three log templates with one copy of each event; ports,
pids, sizes and times are chosen so no line contains ``200``/``201``/``500``
by accident (those substrings are rules of their own).
"""

from __future__ import annotations


def _h(i: int, day: int = 1) -> str:
    return f"May {day:02d} 1{i // 60 % 10}:{i % 60:02d}:{(i * 7) % 60:02d} server "


def _w(ip: str, i: int) -> str:
    return f'{ip} - - [16/May/2026:0{i // 60 % 10}:{i % 60:02d}:{(i * 11) % 60:02d} +0000] "'


def auth_lines() -> list[str]:
    out = []
    for i in range(20):
        out.append(f"{_h(i)}sshd[{1000 + i}]: Failed password for root from 192.168.1.100 port {51000 + i} ssh2")
    for i in range(15):
        out.append(f"{_h(i, 2)}sshd[{1030 + i}]: Failed password for admin from 10.0.0.55 port {51030 + i} ssh2")
    for i in range(15):
        out.append(f"{_h(i, 3)}sshd[{1050 + i}]: Invalid user hacker from 172.16.0.200")
    for i in range(30):
        out.append(f"{_h(i, 4)}sshd[{1070 + i}]: Accepted password for user{i % 3 + 1} from 192.168.1.1 "
                   f"port {51070 + i} ssh2")
    return out


def syslog_lines() -> list[str]:
    out = []
    for i in range(20):
        out.append(f"{_h(i, 5)}kernel[{1100 + i}]: ERROR: Out of memory - process killed")
    for i in range(10):
        out.append(f"{_h(i, 6)}apache2[{1120 + i}]: ERROR: Connection refused")
    for i in range(30):
        out.append(f"{_h(i, 7)}systemd[{1130 + i}]: Started daily cleanup service")
    return out


def apache_lines() -> list[str]:
    out = []
    for i in range(40):
        out.append(f'{_w("192.168.1.2", i)}GET /index.html HTTP/1.1" 200 {3000 + i} "-" "Mozilla/5.0"')
    for i in range(20):
        out.append(f'{_w("192.168.1.100", i)}GET /admin HTTP/1.1" 403 {3040 + i} "-" "curl/7.68.0"')
    for i in range(15):
        out.append(f'{_w("45.33.32.156", i)}GET /.env HTTP/1.1" 404 {3060 + i} "-" "python-requests/2.25"')
    for i in range(10):
        out.append(f'{_w("10.0.0.55", i)}POST /wp-admin HTTP/1.1" 500 {3080 + i} "-" "Mozilla/5.0"')
    return out


def all_lines() -> list[tuple[str, str, str]]:
    return ([(x, "auth.log", "auth") for x in auth_lines()]
            + [(x, "syslog", "syslog") for x in syslog_lines()]
            + [(x, "apache.log", "apache") for x in apache_lines()])


def mixed_lines(spark):
    rows = all_lines()
    return spark.createDataFrame(rows, "line string, source_file string, log_type string").repartition(3)


def lines_df(spark, lines: list[str], log_type: str = "auth", source: str = "auth.log"):
    return spark.createDataFrame([(x, source, log_type) for x in lines],
                                 "line string, source_file string, log_type string")
