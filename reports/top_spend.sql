-- Ten (month, campaign) rows with the highest spend, newest month first.
SELECT report_month, campaign_name, total_spend, roas_3d, cpi
FROM monthly_campaign_summary
ORDER BY report_month DESC, total_spend DESC, campaign_name
LIMIT 10;
