${views}
SELECT * FROM fct_agent_enumeration
