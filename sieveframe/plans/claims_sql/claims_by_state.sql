-- One row a state: how many claims, what they cost, which part of everything that is.
WITH present AS (
  SELECT *, nullif(total_claim_amount, double('NaN')) AS amount FROM claims
),
-- Whole hundredths add up as whole numbers, other amounts as decimals: either way the
-- order of rows cannot change a sum.
amounts AS (
  SELECT *,
         CASE WHEN rint(amount * 100) / 100 = amount AND abs(amount) < 9e13
              THEN CAST(rint(amount * 100) AS BIGINT) END    AS cents,
         CASE WHEN rint(amount * 100) / 100 <> amount OR abs(amount) >= 9e13
              THEN CAST(amount AS DECIMAL(38, 18)) END       AS fine
  FROM present
),
sums AS (
  SELECT incident_state,
         count(*)                                            AS claims,
         CAST(sum(cents) * 0.01BD AS DECIMAL(38, 18))        AS whole,
         sum(fine)                                           AS fine,
         count(amount)                                       AS priced
  FROM amounts
  GROUP BY incident_state
),
groups AS (
  SELECT *, coalesce(whole + fine, whole, fine) AS cost FROM sums
)
SELECT incident_state,
       claims,
       CAST(rint(CAST(cost AS DOUBLE)) AS BIGINT)                        AS total_amount,
       round(try_divide(CAST(cost AS DOUBLE), priced))                   AS avg_amount,
       round(try_divide(100D * CAST(cost AS DOUBLE), CAST(sum(cost) OVER () AS DOUBLE)), 1)    AS pct_of_total_amount
FROM groups
ORDER BY total_amount DESC NULLS LAST, incident_state NULLS LAST
