"""SQL twins of the queries, in DuckDB's dialect over the given tables."""

from __future__ import annotations

# View name -> (views it reads, SQL).  These restate ``views`` independently.
VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "institution": (
        (),
        """SELECT n_nationkey::BIGINT AS id, n_name AS name,
             CASE WHEN n_regionkey = 0 THEN 'AU' ELSE r_name END AS country
           FROM nation JOIN region ON n_regionkey = r_regionkey""",
    ),
    "department": (
        (),
        """SELECT (n_nationkey * 2 + k)::BIGINT AS id, n_nationkey::BIGINT AS institution_id,
             n_name || '/' || k AS name, 1 - k AS is_astronomy
           FROM nation, (VALUES (0), (1)) t(k)""",
    ),
    "person": (
        (),
        """SELECT c_custkey AS id, c_name AS username, 'Customer' AS first_name,
             substring(c_name, 10) AS last_name, c_name || '@example.org' AS email_address,
             (c_custkey % 3)::INT AS gender,
             CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS is_student
           FROM customer""",
    ),
    "person_system": (
        (),
        """SELECT c_custkey AS user_id, 1 AS system_id FROM customer WHERE c_custkey % 2 = 0
           UNION ALL
           SELECT c_custkey, 2 FROM customer WHERE c_custkey % 3 <> 0""",
    ),
    "affiliation": (
        (),
        """SELECT c_custkey AS user_id, (c_nationkey * 2 + c_custkey % 2)::BIGINT AS department_id,
             DATE '1995-01-01' AS start_date,
             CASE WHEN c_custkey % 5 = 0 THEN DATE '1997-06-30' END AS end_date
           FROM customer
           UNION ALL
           SELECT c_custkey, (((c_nationkey + 7) % 25) * 2)::BIGINT, DATE '1997-07-01', NULL
           FROM customer WHERE c_custkey % 5 = 0
           UNION ALL
           SELECT c_custkey, (((c_nationkey + 3) % 25) * 2 + 1)::BIGINT, DATE '1996-01-01', NULL
           FROM customer WHERE c_custkey % 11 = 0""",
    ),
    "project": (
        (),
        """SELECT s_suppkey AS id,
             CASE WHEN s_suppkey % 2 = 0 THEN 'p' ELSE 'oz' END || s_suppkey AS code,
             s_name AS name, s_suppkey AS project_administrator,
             (1 + s_suppkey % 2)::INT AS system_id
           FROM supplier""",
    ),
    "person_project": (
        (),
        """SELECT DISTINCT l_suppkey AS project_id, o_custkey AS user_id
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    ),
    "job_event": (
        (),
        """SELECT l_orderkey, l_linenumber, l_shipdate AS ts,
             CASE WHEN l_linestatus = 'F' THEN 'JOBEND' ELSE 'JOBSTART' END AS type,
             c_name AS username,
             CASE WHEN l_suppkey % 7 = 0 THEN 'root'
               WHEN l_suppkey % 2 = 0 THEN 'p' || l_suppkey ELSE 'oz' || l_suppkey END AS account,
             l_quantity::DECIMAL(18,2) AS service_units
           FROM lineitem JOIN orders ON l_orderkey = o_orderkey
           JOIN customer ON o_custkey = c_custkey""",
    ),
    "finished": (
        ("job_event",),
        """SELECT * FROM job_event WHERE type = 'JOBEND'
             AND ts::DATE BETWEEN DATE '1997-07-01' AND DATE '1997-09-30'""",
    ),
    "total": (("finished",), "SELECT sum(service_units)::DOUBLE AS units FROM finished"),
    "active": (
        ("job_event",),
        """SELECT DISTINCT username FROM job_event
           WHERE ts::DATE BETWEEN DATE '1997-07-01' AND DATE '1997-09-30'""",
    ),
    "member": (
        ("affiliation", "department", "institution", "person"),
        """SELECT a.user_id, a.department_id, a.start_date, a.end_date, p.username, p.first_name,
             p.last_name, p.gender, p.is_student, d.name AS department, d.is_astronomy,
             i.name AS institution, i.country
           FROM affiliation a JOIN department d ON a.department_id = d.id
           JOIN institution i ON d.institution_id = i.id JOIN person p ON a.user_id = p.id""",
    ),
    "member1": (
        ("member", "person_system"),
        "SELECT m.* FROM member m JOIN person_system s ON m.user_id = s.user_id AND s.system_id = 1",
    ),
    "member2": (
        ("member", "person_system"),
        "SELECT m.* FROM member m JOIN person_system s ON m.user_id = s.user_id AND s.system_id = 2",
    ),
    "labelled1": (
        ("member1",),
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY username
             ORDER BY start_date DESC, department_id) AS rn FROM member1) WHERE rn = 1""",
    ),
    "labelled2": (
        ("member2",),
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY username
             ORDER BY start_date DESC, department_id) AS rn FROM member2) WHERE rn = 1""",
    ),
    "latest2": (
        ("member2",),
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
             ORDER BY start_date DESC, department_id) AS rn FROM member2
             WHERE end_date IS NULL) WHERE rn = 1""",
    ),
    "latest_astronomy2": (
        ("member2",),
        """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id
             ORDER BY start_date DESC, department_id) AS rn FROM member2
             WHERE end_date IS NULL AND is_astronomy = 1) WHERE rn = 1""",
    ),
    "extract": (
        ("finished",),
        """SELECT 'c1' AS cluster, username AS login, username AS name, account,
             sum(service_units) AS used, 0.0::DOUBLE AS energy
           FROM finished GROUP BY username, account""",
    ),
    "charged": (
        ("extract",),
        "SELECT * FROM extract WHERE account NOT IN ('hpcadmin', 'testers', 'root')",
    ),
    "charged_total": (("charged",), "SELECT sum(used)::DOUBLE AS units FROM charged"),
    "login_usage": (
        ("charged",),
        "SELECT login AS username, sum(used)::DOUBLE AS units FROM charged GROUP BY login",
    ),
    "dataset_job": (
        (),
        """SELECT user_id::VARCHAR AS username, event_type <> 'error' AS latestjobversion,
             ts AS insertdate, floor(value * 1000000)::BIGINT AS filesize,
             floor(value * 100)::BIGINT AS recordscount,
             CASE event_id % 8 WHEN 0 THEN 'web_multidark_a' WHEN 1 THEN 'multidark_b'
               WHEN 2 THEN 'vishnu_bolshoi_x' WHEN 3 THEN 'bolshoi_planck' WHEN 4 THEN 'bolshoi'
               WHEN 5 THEN 'mini_millennium' WHEN 6 THEN 'other' ELSE '' END AS database
           FROM events""",
    ),
    "counted": (
        ("dataset_job",),
        """SELECT * FROM dataset_job WHERE latestjobversion
             AND insertdate::DATE BETWEEN DATE '2024-01-01' AND DATE '2024-01-15'
             AND username NOT IN ('0', '1')""",
    ),
    "site_user": (
        (),
        """SELECT c_custkey::VARCHAR AS username, (c_custkey % 3)::INT AS gender,
             n_name AS institution,
             CASE WHEN n_regionkey = 0 THEN 'AU' ELSE n_name END AS country,
             CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS is_student
           FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "legacy_user": (
        (),
        """SELECT c_name AS username, n_nationkey::BIGINT AS institution_id,
             n_name AS institution_code,
             CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 1 ELSE 0 END AS student,
             (c_custkey % 3)::INT AS gender
           FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "roster": (
        (),
        """SELECT CASE WHEN c_custkey % 19 = 0 THEN 'ghost' || c_custkey ELSE c_name END AS username,
             CASE WHEN c_custkey % 13 = 0 THEN 'XXX' WHEN c_custkey % 2 = 0 THEN n_name
               ELSE 'N' || n_nationkey END AS institution_code,
             '-' AS field_2,
             CASE WHEN c_custkey % 7 = 0 OR c_custkey % 3 = 2 THEN 'M'
               WHEN c_custkey % 3 = 1 THEN 'F' ELSE '-' END AS gender,
             CASE WHEN (c_mktsegment = 'HOUSEHOLD') <> (c_custkey % 17 = 0)
               THEN 'Y' ELSE 'N' END AS student
           FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "file_listing": (
        (),
        "SELECT 'events_' || n_nationkey AS name, (n_nationkey * 100)::BIGINT AS size FROM nation",
    ),
    "file_ledger": (
        (),
        """SELECT 'events_' || n_nationkey AS name,
             (n_nationkey * CASE WHEN n_nationkey % 3 = 0 THEN 100 ELSE 90 END)::BIGINT AS size
           FROM nation WHERE n_nationkey % 4 <> 0""",
    ),
    "raw_event": (
        (),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, array_to_string([
               '-', t || CASE WHEN l_orderkey % 37 = 0 THEN '' ELSE ':' END
                 || l_orderkey || '.' || l_linenumber % 4,
               CASE WHEN l_orderkey % 29 = 0 THEN 'node' ELSE 'job' END, '-',
               CASE WHEN l_linestatus = 'F' THEN 'JOBEND' ELSE 'JOBSTART' END, '1',
               CASE WHEN l_orderkey % 31 = 0 THEN 'bad' ELSE l_linenumber::VARCHAR END,
               'u' || l_partkey % 40, 'grp', '3600', '-',
               CASE WHEN l_orderkey % 11 = 0 THEN '-' ELSE '[q:1]' END, (t - 7200)::VARCHAR, '-',
               (t - 3600 * l_linenumber - l_partkey % 977)::VARCHAR, t::VARCHAR, '-', '-', '-', '-', '-', '-',
               CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE 'feat' END, '-', '-', '-',
               CASE WHEN l_orderkey % 41 = 0 THEN 'normal' WHEN l_orderkey % 7 = 0 THEN '-:high'
                 WHEN l_orderkey % 7 = 1 THEN 'normal:-' ELSE 'normal:high' END, '-', 'oz' || l_suppkey, '-', '-', '-', '-',
               'part', '-', '-', '-', l_orderkey * 1000000 || 'M', '-', '-', '-', '-', '-',
               CASE WHEN l_orderkey % 5 = 0 THEN '-' ELSE 'rsv1' END, '-', '-', '-', '-',
               '-', '-', '-', '-', '-', '-', '-', (t - 7000)::VARCHAR], ' ') AS value
           FROM (SELECT *, 883612800 + l_orderkey * 120 + l_linenumber AS t FROM lineitem)""",
    ),
    "token": (
        ("raw_event",),
        "SELECT *, string_split(value, ' ') AS t FROM raw_event",
    ),
    "parsed": (
        ("token",),
        """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
             split_part(t[2], ':', 2) AS event_id,
             make_timestamp(split_part(t[2], ':', 1)::BIGINT * 1000000) AS time, t[5] AS type,
             t[6]::BIGINT AS nodes, t[7]::BIGINT AS cpus, t[8] AS "user", t[9] AS "group",
             t[29] AS account, t[4] AS job_id,
             make_timestamp(t[13]::BIGINT * 1000000) AS submit_time,
             make_timestamp(t[15]::BIGINT * 1000000) AS start_time,
             make_timestamp(t[16]::BIGINT * 1000000) AS end_time,
             make_timestamp(t[56]::BIGINT * 1000000) AS eligible_time,
             CASE WHEN t[12] = '-' THEN '' ELSE replace(replace(t[12], '[', ''), ':1]', '') END AS queue,
             t[10]::BIGINT AS reqwall, CASE WHEN t[23] = '-' THEN '' ELSE t[23] END AS features,
             split_part(t[38], 'M', 1)::BIGINT AS memory, t[34] AS "partition",
             CASE WHEN t[44] = '-' THEN '' ELSE t[44] END AS rsv,
             replace(split_part(t[27], ':', 1), '-', '') AS qos_requested,
             replace(split_part(t[27], ':', 2), '-', '') AS qos_delivered,
             ((t[16]::BIGINT - t[15]::BIGINT) * t[7]::BIGINT)::DOUBLE / 3600 AS service_units,
             ((t[16]::BIGINT - t[15]::BIGINT) * t[7]::BIGINT)::DOUBLE AS cpu_seconds
           FROM token WHERE t[3] = 'job' AND t[5] = 'JOBEND' AND TRY_CAST(t[7] AS BIGINT) IS NOT NULL
             AND contains(t[2], ':') AND contains(t[27], ':')""",
    ),
    "stored": (
        ("parsed",),
        """SELECT event_id, time::DATE AS event_date, cpu_seconds FROM (
             SELECT *, row_number() OVER (PARTITION BY event_id
                 ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
             FROM parsed) WHERE rn = 1 AND "user" NOT IN ('u3', 'u17')""",
    ),
    "institution_share": (
        ("finished", "member1", "total"),
        """SELECT m.institution, round(sum(e.service_units)::DOUBLE * 100.0 / any_value(t.units), 2)
             AS percentage
           FROM finished e JOIN (SELECT DISTINCT department_id, institution, department, username,
               start_date, end_date FROM member1) m ON e.username = m.username
             AND e.ts >= m.start_date AND (e.ts <= m.end_date OR m.end_date IS NULL), total t
           GROUP BY m.institution""",
    ),
    "person_share": (
        ("finished", "member", "total"),
        """SELECT m.username, m.first_name || ' ' || m.last_name AS name, m.institution, m.country,
             CASE m.gender WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'None' END AS gender,
             CASE m.is_student WHEN 1 THEN 'Student' WHEN 0 THEN 'Staff' END AS student,
             CASE m.is_astronomy WHEN 1 THEN 'Astronomy' WHEN 0 THEN 'Non-astronomy' END
               AS is_astronomy,
             CASE WHEN m.country = 'AU' THEN 'National Astronomy' ELSE 'Other' END AS is_australia,
             round(sum(e.service_units)::DOUBLE * 100.0 / any_value(t.units), 2) AS percentage
           FROM finished e JOIN (SELECT DISTINCT department_id, department, institution, country,
               is_astronomy, gender, is_student, username, first_name, last_name, start_date,
               end_date FROM member) m ON e.username = m.username
             AND e.ts >= m.start_date AND (e.ts <= m.end_date OR m.end_date IS NULL), total t
           GROUP BY ALL""",
    ),
    "national_share": (
        ("finished", "member", "total"),
        """SELECT m.first_name || ' ' || m.last_name AS name, m.institution, m.username,
             round(sum(e.service_units)::DOUBLE * 100.0 / any_value(t.units), 2) AS percentage
           FROM finished e JOIN (SELECT DISTINCT department_id, department, institution, username,
               first_name, last_name, start_date, end_date FROM member
               WHERE is_astronomy = 1 AND country = 'AU') m ON e.username = m.username
             AND e.ts >= m.start_date AND (e.ts <= m.end_date OR m.end_date IS NULL), total t
           GROUP BY m.first_name, m.last_name, m.institution, m.username""",
    ),
    "demographic_rows": (
        ("person_share",),
        """SELECT c AS criterion, CASE c WHEN 'gender' THEN gender WHEN 'student' THEN student
               WHEN 'is_astronomy' THEN is_astronomy ELSE is_australia END AS grp,
             percentage::DECIMAL(18,2) AS share,
             row_number() OVER (PARTITION BY c ORDER BY percentage DESC, username, institution,
               is_astronomy) AS seen
           FROM person_share,
             (VALUES ('gender'), ('student'), ('is_astronomy'), ('is_australia')) v(c)""",
    ),
    "demographic": (
        ("demographic_rows",),
        """SELECT criterion, position, grp, share, CASE WHEN position = leader THEN whole
               WHEN position = leader + 1 THEN 100 - leader_pct ELSE 0 END::BIGINT AS residual_pct
           FROM (SELECT *, max(CASE WHEN position = leader THEN whole END)
               OVER (PARTITION BY criterion) AS leader_pct
             FROM (SELECT *, min(CASE WHEN whole <> 0 THEN position END)
                 OVER (PARTITION BY criterion) AS leader
               FROM (SELECT criterion, grp, sum(share)::DOUBLE AS share,
                   trunc(sum(share)::DOUBLE)::BIGINT AS whole,
                   row_number() OVER (PARTITION BY criterion ORDER BY min(seen)) AS position
                 FROM demographic_rows GROUP BY criterion, grp)))""",
    ),
    "account_holders": (
        ("member1", "active", "affiliation", "person_system", "person"),
        """SELECT line, label, total, active FROM (
             SELECT 1::BIGINT AS line, 'All' AS label, count(*) AS total,
               count(*) FILTER (username IN (FROM active)) AS active
             FROM member1 WHERE end_date IS NULL
           UNION ALL SELECT 2, 'Male', count(*), count(*) FILTER (username IN (FROM active))
             FROM member1 WHERE end_date IS NULL AND is_astronomy = 1 AND gender = 0
           UNION ALL SELECT 3, 'Female', count(*), count(*) FILTER (username IN (FROM active))
             FROM member1 WHERE end_date IS NULL AND is_astronomy = 1 AND gender = 1
           UNION ALL SELECT 4, 'PhD Student', count(*), count(*) FILTER (username IN (FROM active))
             FROM member1 WHERE end_date IS NULL AND is_astronomy = 1 AND is_student = 1
           UNION ALL SELECT 5, 'Home department', count(*),
               count(*) FILTER (p.username IN (FROM active))
             FROM affiliation a JOIN person_system s ON a.user_id = s.user_id AND s.system_id = 1
             JOIN person p ON a.user_id = p.id WHERE a.department_id = 6)""",
    ),
    "extract_holders": (
        ("member", "member2", "login_usage", "affiliation", "person_system", "person"),
        """SELECT line, label, total, active FROM (
             SELECT 1::BIGINT AS line, 'All' AS label,
               (SELECT count(DISTINCT username) FROM member2
                WHERE end_date IS NULL AND is_astronomy = 1) AS total,
               (SELECT count(*) FROM member WHERE end_date IS NULL AND is_astronomy = 1
                AND username IN (SELECT username FROM login_usage)) AS active
           UNION ALL SELECT 2, 'Male',
               (SELECT count(DISTINCT username) FROM member2
                WHERE end_date IS NULL AND is_astronomy = 1 AND gender = 0),
               (SELECT count(*) FROM member WHERE end_date IS NULL AND is_astronomy = 1
                AND gender = 0 AND username IN (SELECT username FROM login_usage))
           UNION ALL SELECT 3, 'Female',
               (SELECT count(DISTINCT username) FROM member2
                WHERE end_date IS NULL AND is_astronomy = 1 AND gender = 1),
               (SELECT count(*) FROM member WHERE end_date IS NULL AND is_astronomy = 1
                AND gender = 1 AND username IN (SELECT username FROM login_usage))
           UNION ALL SELECT 4, 'PhD Student',
               (SELECT count(DISTINCT username) FROM member2
                WHERE end_date IS NULL AND is_astronomy = 1 AND is_student = 1),
               (SELECT count(*) FROM member WHERE end_date IS NULL AND is_astronomy = 1
                AND is_student = 1 AND username IN (SELECT username FROM login_usage))
           UNION ALL SELECT 5, 'Home department',
               (SELECT count(DISTINCT a.user_id) FROM affiliation a JOIN person_system s
                ON a.user_id = s.user_id WHERE s.system_id = 2 AND a.department_id = 6),
               (SELECT count(*) FROM affiliation a JOIN person_system s ON a.user_id = s.user_id
                JOIN person p ON a.user_id = p.id WHERE s.system_id = 2 AND a.department_id = 6
                AND p.username IN (SELECT username FROM login_usage)))""",
    ),
    "department_astronomers": (
        ("member",),
        """SELECT department_id, institution, count(*) AS users FROM member
           WHERE end_date IS NULL AND is_astronomy = 1 GROUP BY department_id, institution""",
    ),
    "project_share": (
        ("project", "finished", "total"),
        """SELECT p.code, round(a.units * 100.0 / t.units, 3) AS percentage FROM project p LEFT JOIN
             (SELECT account, sum(service_units)::DOUBLE AS units FROM finished GROUP BY account) a
             ON p.code = a.account, total t WHERE p.system_id = 1""",
    ),
    "extract_institution": (
        ("latest2", "login_usage", "charged_total"),
        """SELECT institution, round(coalesce(sum(u.units), 0) * 100.0 / any_value(t.units), 3)
             AS percentage
           FROM latest2 m LEFT JOIN login_usage u ON m.username = u.username, charged_total t
           GROUP BY institution""",
    ),
    "extract_project": (
        ("project", "charged", "charged_total"),
        """SELECT p.code, round(a.units * 100.0 / t.units, 3) AS percentage FROM project p LEFT JOIN
             (SELECT account, sum(used)::DOUBLE AS units FROM charged GROUP BY account) a
             ON p.code = a.account, charged_total t
           WHERE p.system_id = 2 AND lower(p.code) LIKE 'oz%'""",
    ),
    "extract_demographic": (
        ("labelled2", "login_usage", "charged_total"),
        """SELECT criterion, grp, round(sum(units) * 100.0 / any_value(total), 2) AS percentage
           FROM (SELECT c AS criterion, coalesce(u.units, 0) AS units, t.units AS total,
               CASE c WHEN 'gender' THEN CASE m.gender WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' END
                 WHEN 'student' THEN CASE m.is_student WHEN 1 THEN 'Student' ELSE 'Staff' END
                 WHEN 'is_astronomy' THEN
                   CASE m.is_astronomy WHEN 1 THEN 'Astronomy' ELSE 'Non-astronomy' END
                 ELSE CASE WHEN m.country = 'AU' THEN 'National Astronomy' ELSE 'Other' END
               END AS grp
             FROM labelled2 m LEFT JOIN login_usage u ON m.username = u.username, charged_total t,
               (VALUES ('gender'), ('student'), ('is_astronomy'), ('is_australia')) v(c))
           WHERE grp IS NOT NULL GROUP BY criterion, grp""",
    ),
    "extract_astronomers": (
        ("latest_astronomy2",),
        "SELECT institution, count(*) AS users FROM latest_astronomy2 GROUP BY institution",
    ),
    "family": (
        ("counted",),
        """SELECT CASE WHEN database LIKE '%multidark%' THEN 'Multidark'
               WHEN database LIKE '%vishnu_bolshoi%' THEN 'Vishnu Bolshoi'
               WHEN database LIKE '%bolshoi_planck%' THEN 'Bolshoi Planck'
               WHEN database LIKE '%bolshoi%' THEN 'Bolshoi'
               WHEN database LIKE '%millennium%' THEN 'Millennium'
               ELSE 'Ready-Made' END AS family, count(*) AS jobs
           FROM counted WHERE database <> '' GROUP BY 1""",
    ),
    "returned": (
        ("counted",),
        """SELECT coalesce(sum(recordscount), 0)::BIGINT AS records,
             round(coalesce(sum(filesize), 0)::DOUBLE / 1073741824.0, 3) AS gigabytes FROM counted""",
    ),
    "matches": (
        ("roster", "legacy_user"),
        """SELECT r.username, u.username IS NOT NULL AS found,
             CASE WHEN u.username IS NOT NULL THEN
               (r.student = 'Y' AND u.student = 1) OR (r.student = 'N' AND u.student = 0) END
               AS student_match,
             CASE WHEN u.username IS NOT NULL THEN r.institution_code = u.institution_code
               OR coalesce(n.n_name = u.institution_code, false) END AS institution_match,
             CASE WHEN u.username IS NOT NULL THEN (r.gender = 'M' AND u.gender = 2)
               OR (r.gender = 'F' AND u.gender = 1) OR (r.gender = '-' AND u.gender = 0) END
               AS gender_match
           FROM roster r LEFT JOIN legacy_user u ON r.username = u.username
           LEFT JOIN nation n ON r.institution_code = 'N' || n.n_nationkey""",
    ),
    "project_mix": (
        ("person_project", "project", "person", "labelled1"),
        """SELECT p.code AS project_code, count(m.institution) AS members_with_profile,
             count(DISTINCT m.country) > 1 AS international,
             count(DISTINCT CASE WHEN m.country = 'AU' THEN m.institution END) > 1
               AS several_national_institutions
           FROM person_project pp JOIN project p ON pp.project_id = p.id
           JOIN person u ON pp.user_id = u.id LEFT JOIN labelled1 m ON u.username = m.username
           WHERE p.system_id = 1 GROUP BY p.code""",
    ),
    "event_report": (
        ("institution_share", "account_holders", "department_astronomers", "project_share",
         "demographic"),
        """SELECT 1 AS section_no, 'Usage by Institution' AS section, percentage AS order_key,
             institution AS label, percentage::VARCHAR || '%' AS value, NULL::VARCHAR AS active_value
           FROM institution_share
           UNION ALL SELECT 2, 'Astronomy account holders(total/active for quarter)',
             (-line)::DOUBLE, label, total::VARCHAR, active::VARCHAR FROM account_holders
           UNION ALL SELECT 3,
             'Institutions other than Home department with astronomy account holders',
             users::DOUBLE, institution, users::VARCHAR, NULL FROM department_astronomers
           UNION ALL SELECT 4, 'Share of CPU hours usage by project', 0::DOUBLE, code,
             coalesce(percentage::VARCHAR || '%', '-'), NULL FROM project_share
           UNION ALL SELECT 5, 'Usage by Demographic',
             -CASE criterion WHEN 'gender' THEN 1 WHEN 'student' THEN 2 WHEN 'is_astronomy' THEN 3
               ELSE 4 END::DOUBLE, string_agg(grp, ':' ORDER BY position),
             string_agg(residual_pct::VARCHAR, ':' ORDER BY position), NULL
           FROM demographic GROUP BY criterion""",
    ),
    "extract_report": (
        ("extract_institution", "extract_holders", "extract_astronomers", "extract_project",
         "extract_demographic"),
        """SELECT 1 AS section_no, 'Usage by Institution' AS section, percentage AS order_key,
             institution AS label, percentage::VARCHAR || '%' AS value, NULL::VARCHAR AS active_value
           FROM extract_institution
           UNION ALL SELECT 2, 'Astronomy account holders(total/active for quarter)',
             (-line)::DOUBLE, label, total::VARCHAR, active::VARCHAR FROM extract_holders
           UNION ALL SELECT 3,
             'Institutions other than Home department with astronomy account holders',
             users::DOUBLE, institution, users::VARCHAR, NULL FROM extract_astronomers
           UNION ALL SELECT 4, 'Share of CPU hours usage by project', 0::DOUBLE, code,
             coalesce(percentage::VARCHAR || '%', '-'), NULL FROM extract_project
           UNION ALL SELECT 5, 'Usage by Demographic',
             -CASE criterion WHEN 'gender' THEN 1 WHEN 'student' THEN 2 WHEN 'is_astronomy' THEN 3
               ELSE 4 END::DOUBLE, criterion, grp || ':  ' || percentage::VARCHAR || '%', NULL
           FROM extract_demographic""",
    ),
    "dataset_report": (
        ("counted", "returned", "site_user", "family"),
        """SELECT 6 AS section_no,
             'General dataset service Usage (total for 01/01/2024 to 15/01/2024)' AS section,
             order_key, label, value, NULL::VARCHAR AS active_value
           FROM (SELECT -1::DOUBLE AS order_key, 'Number of jobs' AS label,
               count(*)::VARCHAR AS value FROM counted
             UNION ALL SELECT -2, 'Number of active users', count(DISTINCT username)::VARCHAR
               FROM counted
             UNION ALL SELECT -3, 'Total records returned', format('{:,}', records) FROM returned
             UNION ALL SELECT -4, 'Total data-size returned', printf('%.3f GB', gigabytes)
               FROM returned
             UNION ALL SELECT -5, 'Registered users', count(*)::VARCHAR FROM site_user
               WHERE username NOT IN ('0', '1'))
           UNION ALL SELECT 7,
             'General Data access breakdown per database (01/01/2024 to 15/01/2024)',
             jobs::DOUBLE, family, jobs::VARCHAR, NULL FROM family""",
    ),
    **{
        f"{system}_full": (
            (f"{system}_report", "dataset_report"),
            f"""SELECT section_no, replace(section, 'Home department', 'FRANCE') AS section, order_key,
                  CASE WHEN section_no = 2 AND label = 'Home department' THEN 'FRANCE' ELSE label END AS label,
                  value, active_value
                FROM {system}_report WHERE NOT (section_no = 3 AND label = 'FRANCE')
                UNION ALL SELECT * FROM dataset_report""",
        )
        for system in ("event", "extract")
    },
}


def _text_of(report: str) -> str:
    """The lines of a report, section by section."""
    return f"""SELECT section_no, label, CASE section_no
             WHEN 1 THEN rpad(label, 100, ' ') || ' ' || value || ' '
             WHEN 2 THEN rpad(label || ':', 15, ' ')
               || CASE WHEN length(label) > 14 THEN substring(label || ':', 16) ELSE '' END
               || value || '/' || active_value || ' '
             WHEN 3 THEN rpad(label, 70, ' ') || ' ' || lpad(value, greatest(5, length(value))::INT, ' ') || ' '
             WHEN 5 THEN replace(replace(label, ':', '/'), '/ ', ': ') || ' '
               || replace(replace(value, ':', '/'), '/ ', ': ') || ' '
             ELSE rpad(label, 50, ' ') || ' ' || value || ' ' END AS line
           FROM {report}"""


EVENT_COLUMNS = """event_id, time, type, nodes, cpus, "user", "group", account, job_id, submit_time,
  start_time, end_time, eligible_time, queue, reqwall, features, memory, "partition", rsv,
  qos_requested, qos_delivered, service_units, cpu_seconds"""
PERCENT_TEXT = "coalesce(percentage::VARCHAR || '%', '-') AS percentage_text"

# Query name -> (views it reads, SQL).
BODIES: dict[str, tuple[tuple[str, ...], str]] = {
    "src_event_log": (
        ("token",),
        """SELECT t[5] AS type, count(*) AS lines, sum(length(value))::BIGINT AS characters FROM token
           WHERE strftime(make_timestamp(t[56]::BIGINT * 1000000), '%b%Y')
             = 'Jan1998' GROUP BY 1""",
    ),
    "src_usage_extract": (
        ("extract",),
        "SELECT cluster, login, name, account, used::DOUBLE AS used, energy FROM extract",
    ),
    "src_roster": (("roster",), "SELECT * FROM roster"),
    "src_legacy_directory": (("legacy_user",), "SELECT * FROM legacy_user"),
    "evt_parse": (
        ("parsed",),
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {EVENT_COLUMNS} FROM parsed",
    ),
    "evt_service_units": (
        ("parsed",),
        """SELECT "user", count(*) AS jobs, sum(cpu_seconds)::DOUBLE / 3600 AS units
           FROM parsed GROUP BY 1""",
    ),
    "evt_quarantine": (
        ("token",),
        """SELECT l_orderkey, l_linenumber, l_partkey,
             CASE WHEN t[3] <> 'job' THEN 'not a job' WHEN t[5] <> 'JOBEND' THEN 'not a finished job'
               WHEN NOT contains(t[2], ':') THEN 'no event id'
               WHEN NOT contains(t[27], ':') THEN 'no delivered QOS' ELSE 'unreadable number' END AS reason
           FROM token WHERE t[3] <> 'job' OR t[5] <> 'JOBEND' OR TRY_CAST(t[7] AS BIGINT) IS NULL
             OR NOT contains(t[2], ':') OR NOT contains(t[27], ':')""",
    ),
    "flt_drop_admin_usage": (
        ("parsed",),
        """SELECT event_id, "user", service_units::DOUBLE AS units FROM (
             SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY l_partkey, l_suppkey) AS rn
             FROM parsed) WHERE rn = 1 AND "user" NOT IN ('u3', 'u17')""",
    ),
    "snk_append_new_events": (
        ("parsed",),
        """SELECT event_id, "user", account, service_units::DOUBLE AS units FROM (
             SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY l_partkey, l_suppkey) AS rn
             FROM parsed) WHERE rn = 1
             AND event_id NOT IN (SELECT event_id FROM parsed WHERE l_orderkey % 3 = 0)""",
    ),
    "snk_purge_admins": (
        ("parsed",),
        """SELECT event_id, "user", service_units::DOUBLE AS units FROM (
             SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY l_partkey, l_suppkey) AS rn
             FROM parsed) WHERE rn = 1 AND "user" NOT IN ('u3', 'u17')""",
    ),
    "strm_rejects": (
        ("token",),
        """SELECT CASE WHEN t[3] <> 'job' THEN 'not a job' WHEN t[5] <> 'JOBEND' THEN 'not a finished job'
               WHEN NOT contains(t[2], ':') THEN 'no event id'
               WHEN NOT contains(t[27], ':') THEN 'no delivered QOS' ELSE 'unreadable number' END AS reason,
             value, count(*) AS times
           FROM token WHERE t[3] <> 'job' OR t[5] <> 'JOBEND' OR TRY_CAST(t[7] AS BIGINT) IS NULL
             OR NOT contains(t[2], ':') OR NOT contains(t[27], ':') GROUP BY 1, 2""",
    ),
    "strm_grown_files": (
        ("parsed",),
        """SELECT event_id, "user", service_units::DOUBLE AS units FROM (
             SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn
             FROM parsed) WHERE rn = 1 AND "user" NOT IN ('u3', 'u17')""",
    ),
    "src_usage_extract_rejects": (
        ("extract",), "SELECT login, account FROM extract WHERE account LIKE 'p%2' OR account LIKE 'oz%3'",
    ),
    "snk_ledger_plan": (
        ("file_listing", "file_ledger"),
        """SELECT f.name, f.size, l.size AS ledger_size, CASE WHEN l.size IS NULL THEN 'new'
             WHEN l.size = f.size THEN 'unchanged' ELSE 'changed' END AS state
           FROM file_listing f LEFT JOIN file_ledger l ON f.name = l.name""",
    ),
    "snk_ledger_next": (
        ("file_listing", "file_ledger"),
        """SELECT coalesce(f.name, l.name) AS name, coalesce(f.size, l.size) AS size
           FROM file_listing f FULL JOIN file_ledger l ON f.name = l.name""",
    ),
    "use_pct_by_institution_stored": (
        ("institution_share",),
        f"SELECT institution, percentage, {PERCENT_TEXT} FROM institution_share",
    ),
    "strm_ingest": (
        ("stored",),
        """SELECT event_date, count(*) AS events, count(DISTINCT event_id) AS event_ids,
             sum(cpu_seconds)::DOUBLE / 3600 AS units FROM stored GROUP BY event_date""",
    ),
    "dim_user_labels": (
        ("labelled1",),
        """SELECT username, first_name || ' ' || last_name AS name,
             CASE gender WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' WHEN 2 THEN 'None' END AS gender,
             CASE is_student WHEN 1 THEN 'Student' ELSE 'Staff' END AS student,
             CASE is_astronomy WHEN 1 THEN 'Astronomy' ELSE 'Non-astronomy' END AS is_astronomy,
             institution, country,
             CASE WHEN country = 'AU' THEN 'National Astronomy' ELSE 'Other' END AS is_australia
           FROM labelled1""",
    ),
    "dim_projects": (
        ("project", "person"),
        """SELECT left(p.code, 4) AS code, substring(p.code, 6) AS type, p.name,
             u.email_address AS admin_email
           FROM project p JOIN person u ON p.project_administrator = u.id""",
    ),
    "dim_latest_affiliation": (
        ("latest2",),
        "SELECT user_id, username, department_id, institution, start_date FROM latest2",
    ),
    "agg_one_per_user": (
        ("labelled1",),
        "SELECT username, department_id, start_date, end_date FROM labelled1",
    ),
    "per_fiscal_quarter": (
        (),
        """SELECT CASE quarter(o_orderdate) WHEN 3 THEN 1 WHEN 4 THEN 2 WHEN 1 THEN 3 ELSE 4
             END::BIGINT AS fiscal_quarter,
             date_trunc('quarter', o_orderdate)::DATE AS first_day,
             (date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY)::DATE
               AS last_day,
             strftime(date_trunc('quarter', o_orderdate), '%d/%m/%Y') AS first_day_text,
             count(*) AS orders
           FROM orders GROUP BY 1, 2, 3, 4""",
    ),
    "flt_dynamic_conjunction": (
        ("member1",),
        """SELECT 'all' AS predicate, count(*) AS users FROM member1 WHERE end_date IS NULL
           UNION ALL SELECT 'male', count(*) FROM member1
             WHERE end_date IS NULL AND is_astronomy = 1 AND gender = 0
           UNION ALL SELECT 'female', count(*) FROM member1
             WHERE end_date IS NULL AND is_astronomy = 1 AND gender = 1
           UNION ALL SELECT 'student', count(*) FROM member1
             WHERE end_date IS NULL AND is_astronomy = 1 AND is_student = 1
           UNION ALL SELECT 'department', count(*) FROM member1
             WHERE end_date IS NULL AND department_id = 6""",
    ),
    "flt_discard_accounts": (
        ("charged",),
        "SELECT login, account, used::DOUBLE AS used FROM charged",
    ),
    "jn_directory": (
        ("member1",),
        """SELECT user_id, username, department_id, department, institution, country, start_date,
             end_date FROM member1""",
    ),
    "jn_interval_affiliation": (
        ("finished", "member"),
        """SELECT e.l_orderkey, e.l_linenumber, e.username AS "user", m.department_id,
             m.institution, e.service_units::DOUBLE AS units
           FROM finished e JOIN member m ON e.username = m.username AND e.ts >= m.start_date
             AND (e.ts <= m.end_date OR m.end_date IS NULL)""",
    ),
    "jn_semi_active": (
        ("member1", "active"),
        """SELECT user_id, username, department_id FROM member1
           WHERE end_date IS NULL AND username IN (FROM active)""",
    ),
    "jn_anti_excluded": (
        ("dataset_job",),
        """SELECT username, database, filesize, recordscount FROM dataset_job
           WHERE username NOT IN ('0', '1')""",
    ),
    "win_residual_percent": (
        ("institution_share", "institution"),
        """SELECT 'country' AS criterion, position, grp, share,
             CASE WHEN position = leader THEN whole WHEN position = leader + 1 THEN
               100 - (max(CASE WHEN position = leader THEN whole END) OVER ()) ELSE 0 END::BIGINT
               AS residual_pct
           FROM (SELECT *, min(CASE WHEN whole <> 0 THEN position END) OVER () AS leader
             FROM (SELECT i.country AS grp, sum(percentage::DECIMAL(18,2))::DOUBLE AS share,
                 trunc(sum(percentage::DECIMAL(18,2))::DOUBLE)::BIGINT AS whole,
                 row_number() OVER (ORDER BY min(s.seen)) AS position
               FROM (SELECT *, row_number() OVER (ORDER BY percentage DESC, institution) AS seen
                 FROM institution_share) s JOIN institution i ON s.institution = i.name
               GROUP BY i.country))""",
    ),
    "use_total": (("total",), "SELECT coalesce(units, 0) AS total_units FROM total"),
    "use_by_account": (
        ("finished",),
        """SELECT account, sum(service_units)::DOUBLE / 1000.0 AS usage_thousands FROM finished
           GROUP BY account""",
    ),
    "use_by_account_text": (
        ("finished",),
        """SELECT account, printf('%-15s %.6f ', account, sum(service_units)::DOUBLE / 1000.0)
             AS line FROM finished GROUP BY account""",
    ),
    "use_by_user": (
        ("finished",),
        """SELECT username AS "user", sum(service_units)::DOUBLE AS units FROM finished
           GROUP BY username""",
    ),
    "use_pct_by_project": (
        ("project_share",),
        f"SELECT code, percentage, {PERCENT_TEXT} FROM project_share",
    ),
    "use_pct_by_institution": (
        ("institution_share",),
        f"SELECT institution, percentage, {PERCENT_TEXT} FROM institution_share",
    ),
    "use_pct_national_users": (("national_share",), "SELECT * FROM national_share"),
    "use_pct_national_users_text": (
        ("national_share",),
        """SELECT username, institution, rpad(name, 30, ' ') || ' ' || rpad(institution, 50, ' ') || ' '
             || rpad(username, 20, ' ') || ' ' || percentage::VARCHAR || ' ' AS line
           FROM national_share""",
    ),
    "use_pct_by_person": (("person_share",), "SELECT * FROM person_share"),
    "use_pct_by_demographic": (("demographic",), "SELECT * FROM demographic"),
    "collab_by_project": (("project_mix",), "SELECT * FROM project_mix"),
    "collab_summary": (
        ("project_mix",),
        """SELECT count(*) AS projects,
             count(*) FILTER (several_national_institutions) AS several_national,
             count(*) FILTER (several_national_institutions) * 100.0::DOUBLE / count(*)
               AS several_national_pct,
             count(*) FILTER (international) AS international,
             count(*) FILTER (international) * 100.0::DOUBLE / count(*) AS international_pct
           FROM project_mix""",
    ),
    "cnt_users": (
        ("account_holders",),
        "SELECT total AS users FROM account_holders WHERE label = 'Male'",
    ),
    "cnt_active_users": (
        ("account_holders",),
        "SELECT active AS users FROM account_holders WHERE label = 'Male'",
    ),
    "cnt_department_users": (
        ("account_holders",),
        "SELECT total AS users FROM account_holders WHERE line = 5",
    ),
    "cnt_department_active": (
        ("account_holders",),
        "SELECT active AS users FROM account_holders WHERE line = 5",
    ),
    "cnt_astronomers_by_department": (
        ("department_astronomers",),
        "SELECT * FROM department_astronomers",
    ),
    "rpt_account_holders": (("account_holders",), "SELECT * FROM account_holders"),
    "ext_total": (("charged_total",), "SELECT units AS total_units FROM charged_total"),
    "ext_pct_by_project": (
        ("extract_project",),
        f"SELECT code, percentage, {PERCENT_TEXT} FROM extract_project",
    ),
    "ext_pct_by_institution": (
        ("extract_institution",),
        f"SELECT institution, percentage, {PERCENT_TEXT} FROM extract_institution",
    ),
    "ext_pct_by_demographic": (("extract_demographic",), "SELECT * FROM extract_demographic"),
    "ext_active_users": (
        ("extract_holders",),
        "SELECT active AS users FROM extract_holders WHERE label = 'Female'",
    ),
    "ext_department_active": (
        ("extract_holders",),
        "SELECT active AS users FROM extract_holders WHERE line = 5",
    ),
    "ext_users": (
        ("extract_holders",),
        "SELECT total AS users FROM extract_holders WHERE label = 'PhD Student'",
    ),
    "ext_department_users": (
        ("extract_holders",),
        "SELECT total AS users FROM extract_holders WHERE line = 5",
    ),
    "ext_astronomers_by_institution": (
        ("extract_astronomers",),
        "SELECT * FROM extract_astronomers",
    ),
    "ext_account_holders": (("extract_holders",), "SELECT * FROM extract_holders"),
    "ds_jobs": (("counted",), "SELECT count(*) AS jobs FROM counted"),
    "ds_registered_users": (
        ("site_user",),
        "SELECT count(*) AS registered_users FROM site_user WHERE username NOT IN ('0', '1')",
    ),
    "ds_active_users": (
        ("counted",),
        "SELECT count(DISTINCT username) AS active_users FROM counted",
    ),
    "ds_data_size": (
        ("returned",),
        """SELECT records, gigabytes, printf('%.3f GB', gigabytes) AS size_text,
             format('{:,}', records) AS records_text FROM returned""",
    ),
    "ds_jobs_by_family": (("family",), "SELECT * FROM family"),
    "ds_active_user_profiles": (
        ("counted", "site_user"),
        """SELECT DISTINCT u.username, u.gender, u.institution, u.country, u.is_student
           FROM counted c JOIN site_user u ON c.username = u.username
           WHERE u.username::BIGINT % 4 <> 0""",
    ),
    "rec_user_matches": (("matches",), "SELECT * FROM matches"),
    "rec_summary": (
        ("matches",),
        """SELECT count(*) AS roster_users, count(*) FILTER (found) AS found_users,
             count(*) FILTER (NOT gender_match) AS gender_mismatches,
             count(*) FILTER (NOT institution_match) AS institution_mismatches,
             count(*) FILTER (NOT student_match) AS student_mismatches FROM matches""",
    ),
    "rpt_event_path": (("event_report",), "SELECT * FROM event_report"),
    "rpt_extract_path": (("extract_report",), "SELECT * FROM extract_report"),
    "rpt_dataset_section": (("dataset_report",), "SELECT * FROM dataset_report"),
    "rpt_fixed_width": (("event_report",), _text_of("event_report")),
    "rpt_event_full": (("event_full",), "SELECT * FROM event_full"),
    "rpt_extract_full": (("extract_full",), "SELECT * FROM extract_full"),
    "rpt_event_full_text": (("event_full",), _text_of("event_full")),
    "rpt_extract_full_text": (("extract_full",), _text_of("extract_full")),
}


def _with_views(names: tuple[str, ...], body: str) -> str:
    needed: list[str] = []

    def add(name: str) -> None:
        if name in needed:
            return
        for inner in VIEWS[name][0]:
            add(inner)
        needed.append(name)

    for name in names:
        add(name)
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n][1]})" for n in needed) + "\n" + body


TWINS: dict[str, str] = {name: _with_views(*parts) for name, parts in BODIES.items()}
