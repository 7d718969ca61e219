${views},
tgt AS (SELECT * REPLACE (CAST('Changed' AS VARCHAR) AS category) FROM enumeration_raw WHERE create_time <= TIMESTAMP '2024-01-30 00:00:00'),
src AS (SELECT * FROM enumeration_raw WHERE create_time > TIMESTAMP '2024-01-27 00:00:00')
SELECT * FROM tgt UNION ALL SELECT * FROM src WHERE id NOT IN (SELECT id FROM tgt)
