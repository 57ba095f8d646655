-- One row a kind of incident: claims, the part labelled fraud, the usual amount.
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
  SELECT incident_type,
         count(*)                                            AS claims,
         count_if(fraud_reported)                            AS fraud,
         avg(CAST(fraud_reported AS INT))                    AS fraud_share,
         CAST(sum(cents) * 0.01BD AS DECIMAL(38, 18))        AS whole,
         sum(fine)                                           AS fine,
         count(amount)                                       AS priced
  FROM amounts
  GROUP BY incident_type
),
groups AS (
  SELECT *, coalesce(whole + fine, whole, fine) AS cost FROM sums
)
SELECT incident_type,
       claims,
       CAST(fraud AS INT)                      AS fraud_claims,
       round(100D * fraud_share, 1)            AS fraud_pct,
       round(try_divide(CAST(cost AS DOUBLE), priced)) AS avg_amount
FROM groups
ORDER BY fraud_pct DESC NULLS LAST, incident_type NULLS LAST
