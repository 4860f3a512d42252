-- Spend of each campaign by month, with the change against its month before.
SELECT campaign_name, report_month, total_spend,
       total_spend - lag(total_spend) OVER (PARTITION BY campaign_name ORDER BY report_month) AS spend_change
FROM monthly_campaign_summary
ORDER BY campaign_name, report_month;
